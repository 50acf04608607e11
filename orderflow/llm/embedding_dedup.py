"""Near-duplicate vectors: cells of random directions, tile products with rigorous error bounds.

Vectors are scaled to length 1 and rounded to int16 with a scale of their own.  With u
= s q + e, the product of two vectors differs from s s' (q . q') by at most |e| |s' q'|
+ |e'|, and single precision adds a known bound.  A pair is linked if the bounds put it
above the threshold, dropped if they put it below, and only else computed in double
precision from the vectors themselves.

Equal vectors are one class before any product.  Up to ``WHOLE`` classes of one length,
all pairs are compared.  More are dealt into cells, and pairs that share a cell are
compared: of two sets of random directions a vector takes the pairs of directions that
it has most of, ``PROBES`` of them, in each of several tables.  How far along random
directions two vectors lie depends on their cosine alone, so the chance that a pair shares
no cell of any table is known whatever the data: below ``MISSED`` for a pair just at the
threshold, far less for closer ones.  A pair counts in its first cell only.

Every run of cells, and every pair of tiles of a large cell, is one small group; what
leaves it is one count for each vector and a spanning forest of the links, not the links
themselves.  Tables are gone through in rounds, so that vectors are on the way a few at
a time.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import saved
from orderflow.llm.components import connected
from orderflow.session import conf_scope

THRESHOLD = 0.95
# Vectors of a tile; a cell of more than four tiles' is compared tile by tile.
TILE = 8192
# Up to so many vectors of a length share one cell: all pairs are compared.
WHOLE = 1 << 16
# Chance at most that a pair just at the threshold shares no cell.
MISSED = 1e-7
# Cells of a vector in each table.
PROBES = 3
# Directions of a set that are tried.
_SIDES = (16, 32, 64, 128, 192, 256, 384, 512, 768, 1024)
_SEED = 6
# Rows of a tile multiplied at once, and pairs looked at in full at once.
_STRIP = 256
_PAIRS = 1 << 16
# More than rounding can add to a product of two double-precision unit vectors.
_SLACK = 1e-9
# Rows dealt out at once, or their bytes; bytes of a group, and of a round if vectors are few.
_ROWS = 1 << 15
_BYTES = 12 << 20
_GROUP = 24 << 20
_ROUND = 1 << 29
# Shuffle files go when a round ends, not when the driver happens to collect its garbage.
_TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Vectors travel packed: a row of a table is about so many bytes of them, and Python gets few rows
# at once.
_PACKED = 1 << 18
_FEW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "40"}

_PLACED = "dim int, rows binary"
_SENT = "dim int, number int, part bigint, low int, high int, tile int, rows binary"
_GROUPS = ["dim", "number", "part", "low", "high"]
_LINKS = "a bigint, b bigint, links bigint"


class Cells(NamedTuple):
    """Directions of each of the two sets, and tables; no tables: all vectors are in one cell."""

    side: int = 1
    tables: int = 0

    @property
    def kind(self) -> str:
        return "<u2" if self.side <= 256 else "<u4"


class Rounded(NamedTuple):
    """Rounded rows of length 1, in single precision, and at most how far off each was rounded."""

    rows: np.ndarray
    error: np.ndarray


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows as int16 values, their scale, the rounding error's norm and the rounded row's norm."""
    unit = vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    scale = (np.abs(unit).max(axis=1) / 32767).astype(np.float32).astype(np.float64)
    values = np.rint(unit / scale[:, None])
    rounded = values * scale[:, None]
    error = np.sqrt(((unit - rounded) ** 2).sum(axis=1))
    return values.astype(np.int16), scale, error, np.sqrt((rounded**2).sum(axis=1))


def cosines(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    dot = np.einsum("ij,ij->i", one, two)
    return dot / np.sqrt(np.einsum("ij,ij->i", one, one) * np.einsum("ij,ij->i", two, two))


def _even(vectors: np.ndarray) -> np.ndarray:
    """Scaled by powers of two, which changes no cosine: squares neither overflow nor vanish."""
    _, exponents = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponents)


def _product(values: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return values * scale.astype(np.float32)[:, None]


def rounded_links(one: Rounded, two: Rounded | None, threshold: float):
    """Pairs of rows that may have this cosine, and whether they must, strip by strip."""
    own = two is None
    two = one if own else two
    left, right = one.rows, two.rows
    if not len(left) or not len(right):
        return
    # Sums in single precision are off by half an ulp for each term and factor; twice that.
    bound = (left.shape[1] + 8) * 2.0**-23 + _SLACK
    bound += one.error.max() * (1 + two.error.max()) + two.error.max()
    for low in range(0, len(left), _STRIP):
        first = low if own else 0
        product = left[low : low + _STRIP] @ right[first:].T
        found = np.flatnonzero(product >= np.float32(threshold - bound))
        for k in range(0, len(found), _PAIRS):
            part = found[k : k + _PAIRS]
            i, j = np.divmod(part, product.shape[1])
            sure = product.ravel()[part] >= np.float32(threshold + bound)
            if own:
                apart = i < j
                i, j, sure = i[apart], j[apart], sure[apart]
            if len(i):
                yield i + low, j + first, sure


def tile_links(one: np.ndarray, two: np.ndarray | None, threshold: float):
    """Pairs of rows with at least this cosine, strip by strip; without ``two`` within ``one``."""
    rounded: list[Rounded | None] = [None, None]
    for k, x in enumerate(x for x in (one, two) if x is not None):
        values, scale, error, _ = quantise(x)
        rounded[k] = Rounded(_product(values, scale), error)
    two = one if two is None else two
    for i, j, sure in rounded_links(*rounded, threshold):
        open_ = np.flatnonzero(~sure)
        sure[open_] = cosines(one[i[open_]], two[j[open_]]) >= threshold
        yield i[sure], j[sure]


def _forest(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the trees that the links connect: each node's label is the least of its tree."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return labels
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels != labels[labels]).any():
            labels = labels[labels]


def _most(along: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The directions that each row has most of, and how much; ``along`` is used up."""
    rows = np.arange(len(along))
    which = np.empty((len(along), PROBES), np.int64)
    much = np.empty((len(along), PROBES), along.dtype)
    for k in range(PROBES):
        which[:, k] = best = along.argmax(axis=1)
        much[:, k] = along[rows, best]
        along[rows, best] = -np.inf
    return which, much


def cells_of(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Numbers of the cells of each row, by how far it lies along the directions of both sets."""
    side = one.shape[1]
    (i, x), (j, y) = _most(one), _most(two)
    sums = (x[:, :, None] + y[:, None, :]).reshape(len(one), -1)
    best = np.argpartition(-sums, PROBES - 1, axis=1)[:, :PROBES]
    return np.take_along_axis((i[:, :, None] * side + j[:, None, :]).reshape(len(one), -1), best, 1)


@functools.cache
def missed(side: int, threshold: float, dim: int, trials: int = 4000) -> float:
    """Chance, three standard errors up, that a pair at the threshold shares no cell of a table."""
    random = np.random.default_rng(_SEED)
    near, apart = threshold, max(0.0, 1 - threshold**2) ** 0.5
    sets = []
    for _ in range(2):
        # Random directions along one vector, and along what the other has beside it.
        along, beside = random.standard_normal((2, trials, side))
        length = along**2 + beside**2
        if dim > 2:
            length += random.chisquare(dim - 2, length.shape)
        one = along / np.sqrt(length)
        sets.append((one, near * one + apart * beside / np.sqrt(length)))
    one, two = (cells_of(*x) for x in zip(*sets, strict=True))
    chance = 1 - (one[:, :, None] == two[:, None, :]).any(axis=(1, 2)).mean()
    return min(1.0, chance + 3 * (max(chance, 1 / trials) / trials) ** 0.5)


def cells_for(rows: int, threshold: float, dim: int, whole: int = WHOLE) -> Cells:
    """The cheapest way to compare this many vectors: rough nanoseconds of copies and products."""
    best, least = Cells(), rows * 1.2 + rows / TILE * 6000
    for side in _SIDES if rows > whole and 0 < threshold < 1 else ():
        if (chance := missed(side, threshold, dim)) < 1:
            tables = int(np.ceil(np.log(MISSED) / np.log(chance)))
            full = rows * PROBES / side**2
            copy = 6000 + 60_000 / full + 3.5 * full + 1000 * (side > 256)
            cost = tables * (PROBES * copy + 10 * side)
            if cost < least:
                best, least = Cells(side, tables), cost
    return best


def _sets(dim: int, cells: Cells) -> list[np.ndarray]:
    """Each table's directions, the two sets side by side: the same in every task."""
    random = np.random.default_rng((_SEED, dim))
    sets = [random.standard_normal((dim, 2 * cells.side), np.float32) for _ in range(cells.tables)]
    # Of one length, so that cells are about as full.
    return [x / np.sqrt(np.einsum("ij,ij->j", x, x)) for x in sets]


def _record(dim: int, cells: Cells, tables: int, **more: str) -> np.dtype:
    """A rounded vector with its cells in so many tables."""
    fields = [
        *more.items(),
        ("id", "<i8"),
        ("copies", "<i8"),
        ("scale", "<f4"),
        ("error", "<f4"),
        ("values", "<i2", (dim,)),
        ("cells", cells.kind, (tables * PROBES,)),
    ]
    return np.dtype(fields)


def _sent_record(dim: int, cells: Cells, number: int) -> np.dtype:
    """A vector on its way to a cell of this table, with its cells so far."""
    return _record(dim, cells, min(number + 1, cells.tables), cell="<u4")


def _gathered(
    batches: Iterator[pa.RecordBatch], plan: dict[int, Cells]
) -> Iterator[tuple[int, np.ndarray]]:
    """Placed vectors of one length, many at once."""
    held: dict[int, list[np.ndarray]] = {}
    rows = size = 0
    for batch in batches:
        for dim, blob in zip(batch.column("dim").to_pylist(), batch.column("rows"), strict=True):
            cells = plan.get(dim, Cells())
            found = np.frombuffer(blob.as_buffer(), _record(dim, cells, cells.tables))
            held.setdefault(dim, []).append(found)
            rows, size = rows + len(found), size + found.nbytes
            if rows >= _ROWS or size >= _BYTES:
                yield from ((d, np.concatenate(x)) for d, x in held.items())
                held, rows, size = {}, 0, 0
    yield from ((d, np.concatenate(x)) for d, x in held.items())


def _place(plan: dict[int, Cells]):
    """Round vectors and find their cells."""
    sets = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                vectors = some.column("vector").flatten().to_numpy().reshape(-1, dim)
                vectors = _even(vectors.astype(np.float64))
                values, scale, error, _ = quantise(vectors)
                cells = plan.get(dim, Cells())
                if cells.tables and dim not in sets:
                    sets[dim] = _sets(dim, cells)
                rows = _product(values, scale)
                found = np.empty((len(rows), cells.tables * PROBES), cells.kind)
                for k in range(cells.tables):
                    along = rows @ sets[dim][k]
                    halves = along[:, : cells.side], along[:, cells.side :]
                    found[:, k * PROBES : (k + 1) * PROBES] = cells_of(*halves)
                record = np.empty(len(rows), _record(dim, cells, cells.tables))
                record["id"] = some.column("id").to_numpy()
                record["copies"] = some.column("copies").to_numpy()
                record["scale"], record["values"], record["cells"] = scale, values, found
                record["error"] = np.nextafter(error.astype(np.float32), np.float32(np.inf))
                each = max(1, _PACKED // record.itemsize)
                blobs = [record[k : k + each].tobytes() for k in range(0, len(record), each)]
                dims_ = pa.array([dim] * len(blobs), pa.int32())
                rows_ = pa.array(blobs, pa.binary())
                yield pa.RecordBatch.from_pydict({"dim": dims_, "rows": rows_})

    return run


def _crowds(plan: dict[int, Cells], share: dict[int, float]):
    """Cells that hold at least this share of a task's rows, with their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {}
        for dim, rows in _gathered(batches, plan):
            if dim in plan:
                found.setdefault(dim, []).append(rows["cells"].copy())
        for dim, parts in found.items():
            cells = np.concatenate(parts)
            for k in range(plan[dim].tables):
                own = cells[:, k * PROBES : (k + 1) * PROBES]
                number, rows = np.unique(own, return_counts=True)
                many = rows >= max(2, share[dim] * len(cells))
                n = int(many.sum())
                yield pa.RecordBatch.from_pydict(
                    {
                        "dim": pa.array([dim] * n, pa.int32()),
                        "number": pa.array([k] * n, pa.int32()),
                        "part": pa.array(number[many].astype(np.int64)),
                        "rows": pa.array(rows[many].astype(np.int64)),
                    }
                )

    return run


def _run_of(dim: int, cells: Cells, rows: int) -> int:
    """How many cells make a group."""
    each = rows * PROBES / cells.side**2 * _sent_record(dim, cells, cells.tables).itemsize
    return max(1, int(_GROUP / max(each, 1)))


def _send(plan, runs, tiles, turn: int, rounds: int):
    """Deal out the rows of one round's cells: runs of cells, or pairs of tiles of a large cell."""

    def packed(dim: int, number: int, out: list[tuple]) -> pa.RecordBatch:
        part, low, high, tile, blobs = zip(*out, strict=True)
        return pa.RecordBatch.from_pydict(
            {
                "dim": pa.array([dim] * len(out), pa.int32()),
                "number": pa.array([number] * len(out), pa.int32()),
                "part": pa.array(part, pa.int64()),
                "low": pa.array(low, pa.int32()),
                "high": pa.array(high, pa.int32()),
                "tile": pa.array(tile, pa.int32()),
                "rows": pa.array(blobs, pa.binary()),
            }
        )

    def dealt(dim: int, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        cells = plan.get(dim, Cells())
        for number in range(max(1, cells.tables)):
            if cells.tables:
                cell = rows["cells"][:, number * PROBES : (number + 1) * PROBES]
                cell = cell.astype(np.int64).ravel()
                owner = np.repeat(np.arange(len(rows)), PROBES)
            else:
                cell, owner = np.zeros(len(rows), np.int64), np.arange(len(rows))
            large = tiles.get((dim, number), {})
            split = np.isin(cell, list(large)) if large else np.zeros(len(cell), bool)
            part = np.where(split, -1 - cell, cell // runs.get(dim, 1))
            taken = np.flatnonzero((part + number + dim) % rounds == turn)
            # Within a large cell by tile.
            tile = np.zeros(len(cell), np.int64)
            at = taken[split[taken]]
            if len(at):
                numbers = np.array([large[c] for c in cell[at].tolist()])
                tile[at] = rows["id"][owner[at]].view(np.uint64) % numbers.astype(np.uint64)
            keys = (tile[taken], part[taken]) if len(at) else (part[taken],)
            taken = taken[np.lexsort(keys)]
            if not len(taken):
                continue
            record = np.empty(len(taken), _sent_record(dim, cells, number))
            record["cell"] = cell[taken]
            for name in ("id", "copies", "scale", "error", "values"):
                record[name] = rows[name][owner[taken]]
            so_far = record["cells"].shape[1]
            record["cells"] = rows["cells"][owner[taken], :so_far]
            keys = np.stack([part[taken], tile[taken]])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            out, size = [], 0
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(taken)], strict=True):
                blob, p, t = record[low:high].tobytes(), int(keys[0, low]), int(keys[1, low])
                for k in range(large[-1 - p] if p < 0 else 1):
                    out.append((p, min(t, k), max(t, k), t, blob))
                    size += len(blob)
                    if size >= _BYTES:
                        yield packed(dim, number, out)
                        out, size = [], 0
            if out:
                yield packed(dim, number, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, rows in _gathered(batches, plan):
            yield from dealt(dim, rows)

    return run


def _first_met(cells: np.ndarray, i: np.ndarray, j: np.ndarray, cell: int) -> np.ndarray:
    """Which pairs of rows have no common cell before this one, the last table's."""
    # Close pairs mostly share the first cell of all.
    apart = cells[i, 0] != cells[j, 0] if cells.shape[1] > PROBES else np.ones(len(i), bool)
    met = np.flatnonzero(apart)
    for low in range(0, cells.shape[1], PROBES):
        x, y = (cells[k[met], low : low + PROBES] for k in (i, j))
        same = x[:, :, None] == y[:, None, :]
        if low + PROBES == cells.shape[1]:
            same &= (x < cell)[:, :, None]
        met = met[~same.any(axis=(1, 2))]
    return met


def _compare(plan: dict[int, Cells], threshold: float):
    """Links of each group's rows; pairs that rounding leaves open come without a count."""

    def run(key: tuple[pa.Scalar, ...], sent: pa.Table) -> pa.Table:
        dim, number, _, low, high = (x.as_py() for x in key)
        kind = _sent_record(dim, plan.get(dim, Cells()), number)
        tile = sent.column("tile").to_numpy()
        tiles = [
            np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in part])
            for t in dict.fromkeys((low, high))
            if len(part := sent.column("rows").filter(pa.array(tile == t)))
        ]
        # A pair of tiles of which one is empty has a single one here, compared elsewhere.
        shift = len(tiles[0]) if low != high else 0
        both = np.concatenate(tiles)
        order = both["cell"].argsort(kind="stable") if not shift else slice(None)
        cell, ids, copies = (both[x][order] for x in ("cell", "id", "copies"))
        cells = both["cells"][order]
        vectors = _product(both["values"][order], both["scale"][order])
        rounded = Rounded(vectors, both["error"][order])
        ends = [] if shift else (np.flatnonzero(np.diff(cell)) + 1).tolist()
        out: list[tuple[np.ndarray, ...]] = []
        for low, high in zip([0, *ends], [*ends, len(both)], strict=True):
            count, labels, used = np.zeros(high - low, np.int64), np.arange(high - low), False
            one, two = Rounded(*(x[low:high] for x in rounded)), None
            if shift:
                one, two = (
                    Rounded(*(x[k] for x in rounded)) for k in (slice(shift), slice(shift, None))
                )
            for i, j, sure in rounded_links(one, two, threshold):
                j = j + shift
                if cells.shape[1]:
                    met = _first_met(cells[low:high], i, j, int(cell[low]))
                    i, j, sure = i[met], j[met], sure[met]
                if not sure.all():
                    a, b = (ids[low:high][k[~sure]] for k in (i, j))
                    out.append((a, b, np.full(len(a), -1)))
                    i, j = i[sure], j[sure]
                if len(i):
                    np.add.at(count, i, copies[low:high][j])
                    np.add.at(count, j, copies[low:high][i])
                    labels, used = _forest(labels, i, j), True
            if used:
                some = np.flatnonzero(count)
                out.append((ids[low:high][some], ids[low:high][labels[some]], count[some]))
        out = out or [(np.zeros(0, np.int64),) * 3]
        a, b, links = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"a": a, "b": b, "links": pa.array(links, mask=links < 0)})

    return run


def _settle(threshold: float):
    """Open pairs in double precision: links of both ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                one, two = (
                    _even(some.column(x).flatten().to_numpy().reshape(-1, dim).astype(np.float64))
                    for x in ("one", "two")
                )
                some = some.filter(pa.array(cosines(one, two) >= threshold))
                a, b, copies_a, copies_b = (
                    some.column(x).to_numpy() for x in ("a", "b", "copies_a", "copies_b")
                )
                yield pa.RecordBatch.from_pydict(
                    {
                        "a": np.concatenate([a, b]),
                        "b": np.concatenate([b, a]),
                        "links": np.concatenate([copies_b, copies_a]),
                    }
                )

    return run


def _links(classes: DataFrame, threshold: float, tile: int, whole: int) -> DataFrame:
    """``a``, ``b``, ``links``: how many of its links a class has found, and a class in reach."""
    spark = classes.sparkSession
    sizes = classes.groupBy("dim").agg(F.count("*").alias("n"))
    # At most a length for each tile of vectors comes to the driver.
    many = F.collect_list(F.when(F.col("n") > tile, F.struct("dim", "n")))
    groups, many = sizes.agg(F.count("*"), many).first()
    groups = min(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = {r["dim"]: r["n"] for r in many}
    plan = {d: c for d, n in rows.items() if (c := cells_for(n, threshold, d, whole)).tables}
    # Tiles of each table's large cells, by cell.
    tiles = {(d, 0): {0: -(-n // tile)} for d, n in rows.items() if d not in plan}
    placed = saved(
        classes.select("dim", "id", "copies", "vector").mapInArrow(_place(plan), _PLACED), "placed"
    )
    with conf_scope(spark, _FEW):
        found = _rounds(placed, plan, rows, tiles, groups, threshold, tile)
    links = functools.reduce(DataFrame.unionAll, found)
    pairs = links.where("links is null").select("a", "b")
    if not pairs.isEmpty():
        side = classes.select("id", "vector", "copies")
        for end, name in (("a", "one"), ("b", "two")):
            names = {"id": end, "vector": name, "copies": f"copies_{end}"}
            pairs = pairs.join(side.withColumnsRenamed(names), end)
        pairs = pairs.withColumn("dim", F.size("one"))
        settled = saved(pairs.mapInArrow(_settle(threshold), _LINKS), "links")
        links = links.where("links is not null").unionAll(settled)
    return links


def _rounds(
    placed: DataFrame,
    plan: dict[int, Cells],
    rows: dict[int, int],
    tiles: dict[tuple[int, int], dict[int, int]],
    groups: int,
    threshold: float,
    tile: int,
) -> list[DataFrame]:
    """Links and open pairs, table by table of the rounds."""
    runs = {d: _run_of(d, c, rows[d]) for d, c in plan.items()}
    if plan:
        share = {d: 2 * tile / rows[d] for d in plan}
        crowds = placed.mapInArrow(
            _crowds(plan, share), "dim int, number int, part bigint, rows bigint"
        )
        crowds = crowds.groupBy("dim", "number", "part").agg(F.sum("rows").alias("n"))
        for r in crowds.where(F.col("n") > 2 * tile).collect():
            large = tiles.setdefault((r["dim"], r["number"]), {})
            large[r["part"]] = -(-r["n"] // (4 * tile)) + 1
    # A round sends two copies of each vector at most, or half a GB.
    sent = held = 0
    for d, n in rows.items():
        cells = plan.get(d, Cells())
        size = n * _sent_record(d, cells, cells.tables).itemsize
        sent, held = sent + size * cells.tables * PROBES, held + size
        groups += cells.tables * -(-(cells.side**2) // runs.get(d, 1))
    for (d, _), large in tiles.items():
        cells = plan.get(d, Cells())
        size = _sent_record(d, cells, cells.tables).itemsize
        each = 4 * tile if d in plan else tile
        sent += sum(size * each * t * t for t in large.values())
        groups += sum(t * (t + 1) // 2 for t in large.values())
    rounds = max(1, round(sent / max(_ROUND, 2 * held)))
    found = []
    for turn in range(rounds):
        dealt = placed.mapInArrow(_send(plan, runs, tiles, turn, rounds), _SENT)
        # So many partitions that groups keep apart: adaptive planning joins none of them.
        dealt = dealt.repartition(max(1, min(groups // rounds, 20_000)), *_GROUPS)
        links = dealt.groupBy(*_GROUPS).applyInArrow(_compare(plan, threshold), _LINKS)
        found.append(saved(links, "links"))
    return found


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, whole: int = WHOLE
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of each row.

    ``n_links`` counts the other rows with at least this cosine, equal ones too.
    Vectors that are null, empty or zero or have a component that is null or not
    finite link with nothing, as do rows without id; vectors of different lengths do
    not link.  Repeated rows are rows like any other.  Other columns are ignored.
    Of more than ``whole`` different vectors of a length, a pair just at the threshold is
    missed with a chance of ``MISSED`` at most.
    """
    with conf_scope(vectors.sparkSession, _TIDY):
        return _near_vectors(vectors, threshold, tile, whole)


def _near_vectors(vectors: DataFrame, threshold: float, tile: int, whole: int) -> DataFrame:
    value = F.col("embedding").cast("array<double>")
    sound = (
        F.col("vec_id").isNotNull()
        & (F.size("vector") > 0)
        & ~F.exists("vector", lambda x: x.isNull())
        # NaN is above all numbers.
        & (F.array_max("vector") < float("inf"))
        & (F.array_min("vector") > float("-inf"))
        & ((F.array_max("vector") != 0) | (F.array_min("vector") != 0))
    )
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), value.alias("vector"))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    keyed = rows.withColumns(
        {
            "one": F.when(F.col("sound"), F.xxhash64(F.lit(1), "vector")),
            "two": F.when(F.col("sound"), F.xxhash64(F.lit(2), "vector")),
        }
    )
    # Floats are kept as such: the same numbers in half the bytes.
    floats = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "array<float>" if floats else "array<double>"
    classes = keyed.where("sound").groupBy("one", "two")
    classes = saved(
        classes.agg(
            F.min("vec_id").alias("first"),
            F.count("*").alias("copies"),
            F.min(F.col("vector").cast(kind)).alias("vector"),
        ).withColumns({"id": F.xxhash64("one", "two"), "dim": F.size("vector")}),
        "classes",
    )
    keyed = saved(keyed.select("vec_id", "one", "two"), "keys")
    found = _links(classes, threshold, tile, whole)

    # Classes that link or have several rows; other rows stand alone.
    counts = found.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    held = classes.select("one", "two", "id", "first", "copies").join(counts, "id", "left")
    held = saved(held.where("copies > 1 or links is not null"), "held")
    links = F.col("copies") - 1 + F.coalesce("links", F.lit(0))
    linked = held.select("one", "two", "first", links.alias("links"))
    rows = keyed.join(linked, ["one", "two"], "left")
    rows = rows.select("vec_id", F.col("one").isNotNull().alias("sound"), "first", "links")
    rows = saved(rows, "rows")
    # Components are of ids: classes meet over links, and over an id that several share.
    first = held.select("id", "first")
    edges = found.join(first.withColumnsRenamed({"id": "a", "first": "first_a"}), "a")
    edges = edges.join(first.withColumnsRenamed({"id": "b", "first": "first_b"}), "b")
    edges = edges.select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))
    edges = edges.unionByName(rows.select(F.col("vec_id").alias("a"), F.col("first").alias("b")))
    component = connected(edges).withColumnRenamed("id", "vec_id")
    out = rows.join(component, "vec_id", "left")
    component_id = F.when(F.col("sound"), F.col("component"))
    out = out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce(component_id, "vec_id").alias("component_id"),
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return out.withColumn("kept", kept)
