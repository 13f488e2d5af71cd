"""Vectors as short codes: product quantisation with exact integer codebooks.

The parts of the vectors at one position are laid out along a Hilbert curve and
cut into flat blocks, so a block's parts lie close together. A block keeps the
box around its parts and their sum. In each round the distances between box and
codebook entries rule out entries that cannot be nearest to any part of the
block. If one entry is left, the stored sum and count are its share; otherwise
the parts are compared with the shortlist, in exact integers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flarebook.llm.tables import scratch
from flarebook.llm.vectors import matrix, usable

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK_PARTS = 256
CURVE_BITS = 8  # of each component, for the place on the curve
LIMB = 10**18  # long sums are added up in pieces of this base
LONG = 2**63

Codebooks = list[list[list[int]]]  # position, entry, component


def hilbert_keys(cells: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells below 2^bits, as fixed-length bytes."""
    rows, width = cells.shape
    axes = [np.ascontiguousarray(cells[:, i]).astype(np.uint32) for i in range(width)]
    for bit in range(bits - 1, 0, -1):
        top, below = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for axis in axes:  # turn and mirror the lower bits as the curve does in this cell
            mirrored = (axis & top) != 0
            swapped = np.where(mirrored, np.uint32(0), (axes[0] ^ axis) & below)
            axes[0] ^= np.where(mirrored, below, swapped)
            if axis is not axes[0]:
                axis ^= swapped
    for before, axis in zip(axes, axes[1:]):
        axis ^= before
    turned = np.zeros(rows, np.uint32)
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where(axes[-1] & np.uint32(1 << bit), np.uint32((1 << bit) - 1), np.uint32(0))
    digits = [((axis ^ turned) >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1) for axis in axes]
    return np.packbits(np.stack(digits, axis=1).astype(np.uint8), axis=1)


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): 64-bit, or Python integers if any is too large to compare exactly in 64 bits."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if not values.size or np.abs(scaled).max() < exact_below(values.shape[-1]):
        return scaled.astype(np.int64)
    whole = [int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in values.ravel().tolist()]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(values.shape)


def exact_below(width: int) -> float:
    """Components below this have distances of ``width`` components that 64 bits hold."""
    return math.isqrt((LONG - 1) // max(1, 4 * width))


def stored(numbers: np.ndarray) -> bytes:
    """Integers as bytes of one width, led by its name; large ones as text."""
    if numbers.dtype == object:
        return b"t" + ",".join(map(str, numbers.ravel().tolist())).encode()
    most = int(np.abs(numbers).max(initial=0))
    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
    return kind[2].encode() + numbers.astype(kind).tobytes()


def restored(data: bytes, width: int) -> np.ndarray:
    kind = data[:1]
    if kind == b"t":
        whole = [int(x) for x in data[1:].split(b",")] if len(data) > 1 else []
        out = np.empty(len(whole), object)
        out[:] = whole
        return out.reshape(-1, width)
    rows = np.frombuffer(data, f"<i{kind.decode()}", offset=1).astype(np.int64)
    return rows.reshape(-1, width) if width else rows.reshape(0, 0)


CUT = "row long, part int, place binary, numbers binary"


def to_parts(batches: Iterator[pa.RecordBatch], width: int, parts: int, scale: int, low: float, high: float):
    """Rows ``row``, ``vector`` as one row for each part with its place on the curve."""
    step = width // parts
    with np.errstate(over="ignore"):
        spread = max(high / 2 - low / 2, np.finfo(float).tiny)
    for batch in batches:
        vectors = matrix(batch.column(1), width)
        if not len(vectors):
            continue
        cells = np.clip((vectors / 2 - low / 2) / spread * (2**CURVE_BITS - 1), 0, 2**CURVE_BITS - 1)
        for part in range(parts):
            own = slice(part * step, (part + 1) * step)
            keys = hilbert_keys(cells[:, own]) if step else np.zeros((len(vectors), 1), np.uint8)
            numbers = integers(vectors[:, own], scale)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(len(vectors), part), pa.int32()),
                    pa.array([key.tobytes() for key in keys], pa.binary()),
                    pa.array([stored(one) for one in numbers], pa.binary()),
                ],
                names=["row", "part", "place", "numbers"],
            )


BLOCKS = "part int, size int, rows binary, numbers binary, low binary, high binary, sums binary"


def to_blocks(batches: Iterator[pa.RecordBatch], step: int, block_parts: int) -> Iterator[pa.RecordBatch]:
    """Sorted parts in blocks with their box and sum."""
    part, rows, numbers = -1, [], []

    def finished() -> Iterator[pa.RecordBatch]:
        if not rows:
            return
        flat = np.concatenate([restored(one, step) for one in numbers]) if step else np.zeros((len(rows), 0), np.int64)
        whole = [part, len(rows), np.array(rows, "<i8").tobytes(), stored(flat)]
        whole += [stored(edge) for edge in ((flat.min(0), flat.max(0), flat.sum(0)) if step else (flat[0],) * 3)]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        names = ["part", "size", "rows", "numbers", "low", "high", "sums"]
        yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(whole, kinds)], names=names)
        rows.clear()
        numbers.clear()

    for batch in batches:
        for row, own, one in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if own != part or len(rows) == block_parts:
                yield from finished()
                part = own
            rows.append(row)
            numbers.append(one)
    yield from finished()


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """For each box, which entries may be nearest to a point of it.

    An entry is out if its least distance to the box is above the largest
    distance of another, so one that is as near as the nearest is never out.
    """
    below, above = low[:, None, :] - entries, entries - high[:, None, :]
    outside = np.maximum(np.maximum(below, above), 0)
    furthest = np.maximum(np.abs(below), np.abs(above))
    return (outside * outside).sum(-1) <= (furthest * furthest).sum(-1).min(-1)[:, None]


def nearest(numbers: np.ndarray, entries: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each part; among equally near ones the first."""
    apart = numbers[:, None, :] - entries[listed]
    squares = (apart * apart).sum(-1)
    best = squares.argmin(1)
    return listed[best], squares[np.arange(len(best)), best]


def assigned(batches: Iterator[pa.RecordBatch], codebooks: Codebooks, step: int, names: list[str]):
    """The blocks' columns of these names, the part's entries and the block's shortlist."""
    books = []
    for entries in codebooks:
        book = np.empty((len(entries), step), object)
        book[:] = entries
        books.append(book)
    most = max((abs(x) for entries in codebooks for entry in entries for x in entry), default=0)
    narrow = [book.astype(np.int64) for book in books] if most < exact_below(step) else books
    for batch in batches:
        by_name = {name: batch.column(name).to_pylist() for name in ("part", "low", "high", *names)}
        lows = [restored(x, step)[0] if step else np.zeros(0, np.int64) for x in by_name["low"]]
        highs = [restored(x, step)[0] if step else np.zeros(0, np.int64) for x in by_name["high"]]
        parts = np.array(by_name["part"])
        for part in np.unique(parts):
            at = np.flatnonzero(parts == part)
            low, high = np.stack([lows[i] for i in at]), np.stack([highs[i] for i in at])
            entries = narrow[part] if low.dtype != object else books[part]
            for i, listed in zip(at, shortlists(low, high, entries)):
                yield int(part), entries, np.flatnonzero(listed), {name: by_name[name][i] for name in names}


SUMS = "part int, entry int, component int, limb int, value long"


def part_sums(batches: Iterator[pa.RecordBatch], codebooks: Codebooks, step: int) -> Iterator[pa.RecordBatch]:
    """Count (component -1) and component sums of the parts of each entry."""
    counts: dict[tuple[int, int], int] = {}
    sums: dict[tuple[int, int], list[int]] = {}

    def add(key: tuple[int, int], count: int, own: list[int]) -> None:
        counts[key] = counts.get(key, 0) + count
        sums[key] = [x + y for x, y in zip(sums.get(key, [0] * step), own)]

    for part, entries, listed, block in assigned(batches, codebooks, step, ["size", "sums", "numbers"]):
        if len(listed) == 1 or not step:
            add((part, int(listed[0])), block["size"], restored(block["sums"], step)[0].tolist() if step else [])
            continue
        numbers = restored(block["numbers"], step)
        chosen, _ = nearest(numbers, entries, listed)
        for entry in np.unique(chosen):
            own = numbers[chosen == entry]
            add((part, int(entry)), len(own), own.sum(0).tolist())
    out: list[tuple] = []
    for (part, entry), count in counts.items():
        for component, value in enumerate([count, *sums[part, entry]], -1):
            limb, sign = 0, -1 if value < 0 else 1
            value = abs(value)
            while value or not limb:
                value, digit = divmod(value, LIMB)
                out.append((part, entry, component, limb, sign * digit))
                limb += 1
    kinds = [pa.int32()] * 4 + [pa.int64()]
    columns = list(zip(*out)) or [()] * 5
    names = ["part", "entry", "component", "limb", "value"]
    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names=names)


FOUND = "row long, part int, entry int, error long"


def final_entries(batches: Iterator[pa.RecordBatch], codebooks: Codebooks, step: int) -> Iterator[pa.RecordBatch]:
    """Entry and squared distance of each part; null if it passes 64 bits."""
    for part, entries, listed, block in assigned(batches, codebooks, step, ["size", "rows", "numbers"]):
        if step:
            chosen, errors = nearest(restored(block["numbers"], step), entries, listed)
        else:
            chosen = errors = np.zeros(block["size"], np.int64)
        if errors.dtype == object:
            errors = [x if x < LONG else None for x in errors.tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.frombuffer(block["rows"], "<i8")),
                pa.array(np.full(block["size"], part), pa.int32()),
                pa.array(chosen, pa.int32()),
                pa.array(errors, pa.int64()),
            ],
            names=["row", "part", "entry", "error"],
        )


def digest(codebooks: Codebooks) -> str:
    flat = ",".join(str(x) for entries in codebooks for entry in entries for x in entry)
    return hashlib.sha256(flat.encode()).hexdigest()


RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def encode(
    rows: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    block_parts: int = BLOCK_PARTS,
) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error``, ``codebooks_sha256`` of ``vec_id``, ``embedding``, ``label``.

    Vectors that are null or hold a null or non-finite component are dropped.
    Components become floor(scale * x), vectors ``parts`` equal parts; shorter
    vectors, and lengths that do not divide, end in zeros. The first codebooks
    are the parts of the smallest ids (of equal ids, the smallest vectors; null
    ids last; all, if there are fewer). Repeated rows count each. ``error`` is
    null if it passes 64 bits, as is ``label_error`` with such an error in it.
    An empty table has no rows. Besides the codebooks only their sums, as many
    numbers, reach the driver, once a round.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry is two hex digits")
    spark = rows.sparkSession
    vector = F.col("embedding").cast("array<double>")
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("vector"))
    kept = kept.filter(usable(F.col("vector"))).withColumn("row", F.monotonically_increasing_id())
    folder, blocks_folder = scratch(spark, "kept-vectors"), scratch(spark, "vector-blocks")
    kept.write.parquet(folder)
    kept = spark.read.schema(kept.schema).parquet(folder)

    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(entries).collect()
    if not first:
        return spark.createDataFrame([], RESULT)
    widest, low, high = kept.agg(
        F.max(F.size("vector")), F.min(F.array_min("vector")), F.max(F.array_max("vector"))
    ).first()
    width = -(-widest // parts) * parts
    step, low, high = width // parts, low or 0.0, high or 0.0
    start = np.zeros((len(first), width))
    for at, row in enumerate(first):
        start[at, : len(row.vector)] = row.vector
    whole = integers(start, scale)
    codebooks = [whole[:, i * step : (i + 1) * step].tolist() for i in range(parts)]

    pieces = kept.select("row", "vector").mapInArrow(
        lambda batches: to_parts(batches, width, parts, scale, low, high), CUT
    )
    laid = pieces.repartitionByRange("part", "place", "row").sortWithinPartitions("part", "place", "row")
    blocks = laid.select("row", "part", "numbers").mapInArrow(lambda b: to_blocks(b, step, block_parts), BLOCKS)
    blocks.write.parquet(blocks_folder)
    blocks = spark.read.schema(blocks.schema).parquet(blocks_folder)

    for _ in range(rounds):
        codebooks = moved(blocks.drop("rows"), codebooks, step)
    found = blocks.drop("sums").mapInArrow(lambda batches, books=codebooks: final_entries(batches, books, step), FOUND)
    whole_error = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)")))
    codes = found.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("part", "entry"))).alias("entries"),
        whole_error.alias("error"),
    )
    codes = codes.select(
        "row",
        F.array_join(F.transform("entries", lambda e: F.lpad(F.lower(F.hex(e["entry"])), 2, "0")), "").alias("code"),
        F.col("error").try_cast("long").alias("error"),
    )
    coded = kept.select("row", "vec_id", "label").join(codes, "row")
    by_label = coded.groupBy(F.col("label").alias("own_label")).agg(whole_error.alias("total"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("own_label"))).select(
        "vec_id",
        "code",
        "error",
        F.col("total").try_cast("long").alias("label_error"),
        F.lit(digest(codebooks)).alias("codebooks_sha256"),
    )


def moved(blocks: DataFrame, codebooks: Codebooks, step: int) -> Codebooks:
    """Each entry at the floor of its parts' mean; unused ones stay."""
    sums = blocks.mapInArrow(lambda batches: part_sums(batches, codebooks, step), SUMS)
    sums = sums.groupBy("part", "entry", "component", "limb").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    )
    totals: dict[tuple[int, int], dict[int, int]] = {}
    for part, entry, component, limb, value in sums.collect():
        own = totals.setdefault((part, entry), {})
        own[component] = own.get(component, 0) + int(value) * LIMB**limb
    after = [[list(entry) for entry in entries] for entries in codebooks]
    for (part, entry), own in totals.items():
        after[part][entry] = [own[i] // own[-1] for i in range(step)]
    return after
