"""Copies among images by local descriptors.

Corners of several scales get 256 binary tests, turned to the corner's orientation. Descriptors meet in Hamming tables, each
keyed by 40 of the tests, with 8 tests of a corner beside it. Pictures in which two such corners lie alike are compared corner by
corner, and their matches must agree on one similarity transform (turn, scale and shift) to make a link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.components import connected_components
from corvane.llm.store import discard, materialize

SCALES = (1.0, 0.84, 0.707, 0.595, 0.5)
RADIUS, TURNS, TESTS = 14, 72, 256
#: A corner is the strongest place so many pixels around it, so their number grows with the picture.
APART = 8
TABLES, KEY_BITS = 4, 40
#: A corner is known together with each of so many corners of its scale nearest to it, of which the first 8 tests of the table go into the key.
BESIDE = 3
#: How two corners lie: the way from one to the other and the other's turn, both against the one's turn, in 256 steps, and their distance, in steps of a 16th octave. Such places may differ by so many steps.
TURN_STEPS, LENGTH_STEPS = 15, 5
#: Two pictures that meet once only are compared if of 32 further tests, half of either corner's, no more than so many differ.
ONCE = 4
#: A match may differ in so many of the 256 tests; a link needs so many matches that agree on one transform.
HAMMING, AGREEING = 60, 5
SHIFT = 4.0
#: So many pictures of one size are described at a time.
STACK = 32
#: Pictures of a bucket that one task compares with as many others.
BLOCK = 256

_DISC = np.array([(y, x) for y in range(-RADIUS, RADIUS + 1, 2) for x in range(-RADIUS, RADIUS + 1, 2) if y * y + x * x <= RADIUS * RADIUS], np.int32)


def _pattern() -> np.ndarray:
    """Test points, (turn, test, first or second, y or x), from a fixed draw.

    Tests come in an order in which each is as little correlated as can be with those before it, and with the orientation, if
    brightness is smooth over about three pixels; so the first bits of a descriptor tell most.
    """
    draw = np.random.default_rng(20).normal(0, RADIUS / 2, (4 * TESTS, 2, 2))
    draw = draw[(np.hypot(draw[..., 0], draw[..., 1]) < RADIUS - 1).all(1) & (np.hypot(*(draw[:, 0] - draw[:, 1]).T) > 4)]

    def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.exp(-((a[:, None] - b[None]) ** 2).sum(-1) / 18)

    one, two, disc = draw[:, 0], draw[:, 1], _DISC.astype(float)
    spread = 2 - 2 * np.exp(-((one - two) ** 2).sum(1) / 18)
    together = np.abs(alike(one, one) + alike(two, two) - alike(one, two) - alike(two, one)) / np.sqrt(spread[:, None] * spread)
    turned = ((alike(one, disc) - alike(two, disc)) * disc[:, 1]).sum(1)
    worst = np.abs(turned) / np.sqrt(spread * (alike(disc, disc) * np.outer(disc[:, 1], disc[:, 1])).sum())
    order = []
    for _ in range(TESTS):
        best = int(np.argmin(worst))
        order.append(best)
        worst = np.maximum(worst, together[best])
        worst[best] = 2
    turn = 2 * np.pi * np.arange(TURNS) / TURNS
    y, x = draw[order][..., 0], draw[order][..., 1]
    c, s = np.cos(turn)[:, None, None], np.sin(turn)[:, None, None]
    return np.rint(np.stack([c * y + s * x, c * x - s * y], -1)).astype(np.int32)


_PATTERN = _pattern()


def _part(a: np.ndarray, axis: int, start: int, size: int) -> np.ndarray:
    return a[tuple(slice(start, start + size) if i == axis else slice(None) for i in range(a.ndim))]


def _sums(a: np.ndarray, k: int) -> np.ndarray:
    """Sums over squares of ``k`` pixels, of a stack of pictures."""
    for axis in (1, 2):
        n = a.shape[axis] - k + 1
        total = _part(a, axis, 0, n) + _part(a, axis, 1, n)
        for i in range(2, k):
            total += _part(a, axis, i, n)
        a = total
    return a


def _box(a: np.ndarray, r: int) -> np.ndarray:
    """Means over squares of 2r+1 pixels; edges are repeated."""
    return _sums(np.pad(a, ((0, 0), (r, r), (r, r)), mode="edge"), 2 * r + 1) * np.float32(1 / (2 * r + 1) ** 2)


def _highest(a: np.ndarray, r: int) -> np.ndarray:
    """Maxima over squares of 2r+1 pixels, by doubling."""
    for axis in (1, 2):
        reach = 1
        while reach < 2 * r + 1:
            step = min(reach, 2 * r + 1 - reach)
            n = a.shape[axis] - step
            a = np.maximum(_part(a, axis, 0, n), _part(a, axis, step, n))
            reach += step
    return a


def resizing(n: int, scale: float) -> np.ndarray:
    """The matrix that resizes a line of ``n`` pixels, each new pixel a triangular mean of old ones."""
    at = (np.arange(int(n * scale)) + 0.5) / scale - 0.5
    weight = np.maximum(0, 1 - np.abs(np.arange(n) - at[:, None]) * min(scale, 1)).astype(np.float32)
    return weight / weight.sum(1, keepdims=True)


def _corners(a: np.ndarray) -> tuple[np.ndarray, ...]:
    """Picture, y and x of the corners of a stack that lie far enough from the edge for their tests."""
    edge = RADIUS + 1
    gy, gx = a[:, 2:, 1:-1] - a[:, :-2, 1:-1], a[:, 1:-1, 2:] - a[:, 1:-1, :-2]
    yy, xx, xy = (_sums(g, 5) * np.float32(1 / 100) for g in (gy * gy, gx * gx, gy * gx))
    strength = yy * xx - xy * xy - np.float32(0.05) * (yy + xx) ** 2
    cut = edge - 3
    inner = strength[:, cut:-cut, cut:-cut]
    top = _highest(np.pad(strength, ((0, 0), (APART, APART), (APART, APART)), constant_values=-np.inf), APART)[:, cut:-cut, cut:-cut]
    n, y, x = np.nonzero((inner == top) & (inner > 1e-3))
    return n, y + edge, x + edge


def describe_stack(stack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Corners of pictures of one size: which picture, place (x, y, scale, turn) in its pixels, and descriptor as 32 bytes."""
    whole, places, codes = [], [], []
    base = stack.astype(np.float32)
    height, width = base.shape[1:]
    for scale in SCALES:
        if int(min(height, width) * scale) <= 2 * RADIUS + 3:
            continue
        a = _box(base if scale == 1 else resizing(height, scale) @ base @ resizing(width, scale).T, 1)
        n, y, x = _corners(a)
        if not len(n):
            continue
        smooth = _box(a, 3)
        h, w = smooth.shape[1:]
        flat, at = np.round(smooth, 3).ravel(), (n * h + y) * w + x
        disc = flat[at[:, None] + (_DISC[:, 0] * w + _DISC[:, 1])]
        angle = np.arctan2(disc @ _DISC[:, 0].astype(np.float32), disc @ _DISC[:, 1].astype(np.float32))
        turn = np.rint(angle / (2 * np.pi) * TURNS).astype(int) % TURNS
        value = flat[at[:, None, None] + (_PATTERN[..., 0] * w + _PATTERN[..., 1])[turn]]
        whole.append(n)
        places.append(np.stack([(x + 0.5) / scale, (y + 0.5) / scale, np.full(len(n), scale), angle], 1).astype(np.float32))
        codes.append(np.packbits(value[:, :, 0] < value[:, :, 1], axis=1))
    if not whole:
        return np.zeros(0, np.int64), np.zeros((0, 4), np.float32), np.zeros((0, TESTS // 8), np.uint8)
    n = np.concatenate(whole)
    order = np.argsort(n, kind="stable")
    return n[order], np.concatenate(places)[order], np.concatenate(codes)[order]


def describe(gray: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and descriptors of one picture's corners."""
    return describe_stack(gray[None])[1:]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many tests each descriptor of ``a`` differs from each of ``b``."""
    return np.bitwise_count(np.ascontiguousarray(a).view("<u8")[:, None] ^ np.ascontiguousarray(b).view("<u8")[None]).sum(2)


def _grouped(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal places follow each other, and where each begins in it."""
    order = np.lexsort(places.T)
    new = np.ones(len(places), bool)
    new[1:] = (np.diff(places[order], axis=0) != 0).any(1)
    return order, np.nonzero(new)[0]


def agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Most matches (rows of a and b: x, y, scale, turn) that one similarity transform explains, each corner once."""
    if not len(a):
        return 0
    best = 0
    turn = b[:, 3] - a[:, 3]
    size = a[:, 2] / b[:, 2]
    corners = [_grouped(np.rint(x[:, :2] / 4)) for x in (a, b)]
    chunk = 1 + (1 << 18) // len(a)
    for start in range(0, len(a), chunk):
        k = slice(start, start + chunk)
        t, s = turn[k, None], size[k, None]
        c, n = np.cos(t) * s, np.sin(t) * s
        x, y = (a[:, i] - a[k, i, None] for i in (0, 1))
        near = (np.abs(x * c - y * n + b[k, 0, None] - b[:, 0]) <= SHIFT * np.maximum(1, s)) & (np.abs(x * n + y * c + b[k, 1, None] - b[:, 1]) <= SHIFT * np.maximum(1, s))
        near &= (np.abs((turn - t + np.pi) % (2 * np.pi) - np.pi) < 0.35) & (np.abs(np.log2(size / s)) < 0.3)
        near = near[near.sum(1) > best]
        if len(near):
            each = [np.logical_or.reduceat(near[:, order], starts, axis=1).sum(1) for order, starts in corners]
            best = max(best, int(np.minimum(*each).max()))
    return best


def linked(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """How many matches of two described pictures agree on one transform; 0 if too few for a link."""
    if len(a[0]) < AGREEING or len(b[0]) < AGREEING:
        return 0
    i, j = np.nonzero(distances(a[1], b[1]) <= HAMMING)
    if len(i) < AGREEING:
        return 0
    n = agreeing(a[0][i], b[0][j])
    return n if n >= AGREEING else 0


def table_keys(codes: np.ndarray) -> np.ndarray:
    """A column for each Hamming table: every TABLES-th of the first tests, with the table's number."""
    bits = np.unpackbits(codes, axis=1)
    keys = []
    for t in range(TABLES):
        packed = np.packbits(bits[:, t : TABLES * KEY_BITS : TABLES], axis=1)
        keys.append(np.pad(packed, ((0, 0), (0, 8 - packed.shape[1]))).view("<i8")[:, 0] * TABLES + t)
    return np.stack(keys, 1) if keys else np.zeros((len(codes), 0), np.int64)


def beside(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every corner with each of the BESIDE corners of its scale nearest to it, as two rows of numbers; one that is alone in its scale is beside itself."""
    ones, others = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for scale in np.unique(places[:, 2]):
        at = np.nonzero(places[:, 2] == scale)[0]
        most = min(BESIDE, len(at) - 1)
        if not most:
            ones.append(at)
            others.append(at)
        chunk = 1 + (1 << 20) // len(at)
        for start in range(0, len(at) if most else 0, chunk):
            some = at[start : start + chunk]
            away = ((places[some, None, :2] - places[at, :2]) ** 2).sum(2)
            away[np.arange(len(some)), np.arange(start, start + len(some))] = np.inf
            ones.append(np.repeat(some, most))
            others.append(at[np.argsort(away, axis=1, kind="stable")[:, :most]].ravel())
    return np.concatenate(ones), np.concatenate(others)


def shapes(places: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How corners ``other`` lie seen from corners ``one``, the same however the picture is turned, sized and shifted: way, turn and distance, a byte each."""
    step = (places[other, :2] - places[one, :2]) * places[one, 2:3]
    way = np.rint((np.arctan2(step[:, 1], step[:, 0]) - places[one, 3]) * (128 / np.pi)).astype(np.int32) % 256
    turn = np.rint((places[other, 3] - places[one, 3]) * (128 / np.pi)).astype(np.int32) % 256
    length = np.clip(np.rint(16 * np.log2(np.maximum(np.hypot(step[:, 0], step[:, 1]), 1))), 0, 255).astype(np.int32)
    return np.where(one == other, 0, way << 16 | turn << 8 | length)


def shapes_alike(a: str, b: str) -> Column:
    """Whether two shapes may be the same two corners'."""

    def byte(c: str, n: int) -> Column:
        return F.shiftright(F.col(c), 8 * n).bitwiseAND(255)

    turned = [F.abs(byte(a, n) - byte(b, n)) for n in (2, 1)]
    return reduce(lambda x, y: x & y, [F.least(d, 256 - d) <= TURN_STEPS for d in turned], F.abs(byte(a, 0) - byte(b, 0)) <= LENGTH_STEPS)


def decode(pixels: bytes | None, width: int | None, height: int | None) -> np.ndarray:
    """Eight-bit gray pixels by rows; anything that doesn't fit its size is an empty image."""
    if not pixels or not width or not height or width < 1 or height < 1 or len(pixels) != width * height:
        return np.zeros((0, 0), np.uint8)
    return np.frombuffer(pixels, np.uint8).reshape(height, width)


_SEEN = "image_id long, key binary, n_corners long, places binary, codes binary"


#: How a corner's place is stored: the scale by its number, the turn in 256 steps.
_PLACE = np.dtype([("x", "<f4"), ("y", "<f4"), ("scale", "u1"), ("turn", "u1")])


def packed_places(places: np.ndarray) -> bytes:
    out = np.zeros(len(places), _PLACE)
    out["x"], out["y"] = places[:, 0], places[:, 1]
    out["scale"] = np.abs(places[:, 2:3] - np.array(SCALES, np.float32)).argmin(1)
    out["turn"] = np.rint(places[:, 3] * 128 / np.pi).astype(int) % 256
    return out.tobytes()


def unpacked_places(data: bytes) -> np.ndarray:
    p = np.frombuffer(data, _PLACE)
    return np.stack([p["x"], p["y"], np.array(SCALES)[p["scale"]], p["turn"] * (np.pi / 128)], 1)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys: list[bytes | None] = [None] * len(batch)
        found = [(np.zeros((0, 4), np.float32), np.zeros((0, TESTS // 8), np.uint8))] * len(batch)
        by_size: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}

        def flush(group: list[tuple[int, np.ndarray]], found: list = found) -> None:
            n, place, code = describe_stack(np.stack([image for _, image in group]))
            edge = np.searchsorted(n, np.arange(len(group) + 1))
            for k, (at, _) in enumerate(group):
                found[at] = place[edge[k] : edge[k + 1]], code[edge[k] : edge[k + 1]]
            group.clear()

        for at, (w, h, p) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True)):
            image = decode(p.as_py(), w, h)
            if not image.size:
                continue
            keys[at] = hashlib.sha256(f"{w}x{h}:".encode() + p.as_py()).digest()
            group = by_size.setdefault(image.shape, [])
            group.append((at, image))
            if len(group) == STACK or len(group) * image.size > 1 << 22:
                flush(group)
        for group in by_size.values():
            if group:
                flush(group)
        if keys:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array([len(x) for x, _ in found], pa.int64()), pa.array([packed_places(x) for x, _ in found], pa.binary()), pa.array([c.tobytes() for _, c in found], pa.binary())],
                names=["image_id", "key", "n_corners", "places", "codes"],
            )


def _bucketed(batches: Iterator[pa.RecordBatch], tested: bool = False) -> Iterator[pa.RecordBatch]:
    """One row for each picture, bucket of a Hamming table that a corner with one beside it falls in, and shape of the two; if ``tested``, with 32 tests of theirs by which no bucket is known, in its higher bits."""
    for batch in batches:
        found = []
        for i, p, c in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            places = unpacked_places(p.as_py() or b"")
            codes = np.frombuffer(c.as_py() or b"", np.uint8).reshape(-1, TESTS // 8)
            keys = table_keys(codes)
            one, other = beside(places)
            shape = shapes(places, one, other)
            if tested:  # tables know 0 to 159 of the one's tests, 128 to 159 of the other's
                shape = shape | np.concatenate([codes[one, 20:22], codes[other, :2]], 1).view("<u4")[:, 0].astype(np.int64) << 24
            bucket, shape = (keys[one] << 8 | keys[other] // TABLES & 255).ravel(), np.repeat(shape, TABLES)
            order = np.lexsort((shape, bucket))
            bucket, shape = bucket[order], shape[order]
            new = np.ones(len(bucket), bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (shape[1:] != shape[:-1])
            found.append((np.full(new.sum(), i, np.int64), bucket[new], shape[new].astype(np.int64 if tested else np.int32)))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["image_id", "bucket", "shape"])


def _bucketed_with_tests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _bucketed(batches, True)


def _verified(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def read(places: bytes, codes: bytes) -> tuple[np.ndarray, np.ndarray]:
        return unpacked_places(places), np.frombuffer(codes, np.uint8).reshape(-1, TESTS // 8)

    for frame in frames:
        out = []
        for u, v, left, right in zip(*(frame[c] for c in ("u", "v", "left", "right")), strict=True):
            n = linked(read(left["places"], left["codes"]), read(right["places"], right["codes"]))
            if n:
                out.append((u, v, n))
        yield pd.DataFrame(out, columns=["u", "v", "agreeing"], dtype="int64")


def _met(buckets: DataFrame, block: int) -> DataFrame:
    """Each row of a bucket beside those of the ``block`` rows that follow it whose shapes are like its own, and once, not ``alike``, each row of larger buckets; written, so that buckets are dealt and sorted once."""
    rows = buckets if "shape" in buckets.columns else buckets.withColumn("shape", F.lit(0))
    in_bucket = Window.partitionBy("bucket").orderBy("image_id", "shape")
    size = F.count("*").over(in_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # Two lists, as a structure would be made, and shuffled, beside the columns that it is made of.
    later = [F.collect_list(c).over(in_bucket.rowsBetween(1, block)).alias(f"{c}_later") for c in ("image_id", "shape")]
    placed = rows.select("image_id", "shape", "bucket").select("*", F.row_number().over(in_bucket).alias("number"), (size > block + 1).alias("large"), *later)
    each = placed.select("*", F.posexplode_outer(F.arrays_zip("image_id_later", "shape_later")).alias("nth", "other"))
    met = each.select("image_id", "shape", "bucket", "number", "large", (F.coalesce("nth", F.lit(0)) == 0).alias("first"), F.col("other.image_id_later").alias("image_id_v"), F.col("other.shape_later").alias("shape_v"))
    return materialize(met.withColumn("alike", F.coalesce(_alike(), F.lit(False))).where(F.col("alike") | (F.col("large") & F.col("first"))), "met")


def _alike() -> Column:
    return (F.col("image_id") < F.col("image_id_v")) & shapes_alike("shape", "shape_v")


def _meetings(buckets: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row ``u, v`` (u < v) for each two rows of pictures in a bucket of ``buckets(image_id, bucket, shape)`` whose shapes are alike; without shapes all are. ``differ`` counts the tests in the shapes that differ.

    A row meets the ``block`` rows that follow it in its bucket where they lie. The rest of a large bucket's rows are dealt to blocks, and blocks meet in pairs, each pair of blocks
    by itself, so the pairs of a large bucket are many tasks' work.
    """
    return _pairs(_met(buckets, block), block)


def _pairs(met: DataFrame, block: int) -> DataFrame:
    def pairs(found: DataFrame) -> DataFrame:
        differ = F.bit_count(F.shiftrightunsigned(F.col("shape").bitwiseXOR(F.col("shape_v")), 24))
        return found.select(F.col("image_id").alias("u"), F.col("image_id_v").alias("v"), differ.alias("differ"))

    crowd = met.where("large and first").withColumn("own", F.floor((F.col("number") - 1) / block).cast("int"))
    last = crowd.groupBy("bucket").agg(F.max("own").alias("last"))
    left = crowd.join(last, "bucket").select("bucket", F.col("own").alias("a"), F.explode(F.sequence("own", "last")).alias("b"), "image_id", "shape", "number")
    right = crowd.select("bucket", F.explode(F.sequence(F.lit(0), "own")).alias("a"), F.col("own").alias("b"), *[F.col(c).alias(f"{c}_v") for c in ("image_id", "shape", "number")])
    far = left.join(right, ["bucket", "a", "b"]).where((F.col("number_v") > F.col("number") + block) & _alike())
    return pairs(met.where("alike")).unionByName(pairs(far))


def _compared(meetings: DataFrame) -> DataFrame:
    """Of ``meetings(u, v, differ)`` the pairs to be compared: those that meet more than once, or once with corners whose further tests differ little, too.

    Copies meet many times; strangers nearly always once, and their number grows with the square of the pictures'.
    """
    return meetings.groupBy("u", "v").agg(F.count("*").alias("n"), F.min("differ").alias("differ")).where((F.col("n") > 1) | (F.col("differ") <= ONCE)).select("u", "v")


def image_copies(images: DataFrame) -> DataFrame:
    """One row per row of ``images(image_id, width, height, pixels, ...)``: ``image_id, n_corners, component_id, n_links, kept``.

    ``component_id`` is the smallest image_id that links reach, ``n_links`` counts the links of the image's representative to
    other pictures, ``kept`` says whether the row is its component's first. Equal pictures are first reduced to one
    representative. In a bucket of a Hamming table each picture meets every other. Two pictures are compared in full, all corners with all, if in some
    bucket both have a corner and one beside it that lie alike, and that happens twice or these corners' further tests differ little.

    Null, empty and misfit pixels have no corners and are linked with nothing, nor are rows without image_id, whose
    component is null and which are kept; repeated rows get the same answer each; of different pictures of one image_id the
    one whose corners come first in byte order is compared; an empty table gives an empty one; other columns are not read.
    """
    source = images.select(F.col("image_id").cast("long").alias("image_id"), F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"), F.col("pixels").cast("binary").alias("pixels"))
    seen = materialize(source.mapInArrow(_described, _SEEN), "pictures")
    classes = materialize(seen.where("image_id is not null and key is not null").groupBy("key").agg(F.min("image_id").alias("rep")), "classes")
    reps = seen.where(F.col("n_corners") >= AGREEING).join(classes.withColumnRenamed("rep", "image_id"), ["key", "image_id"], "left_semi").select("image_id", "places", "codes")
    buckets = reps.select("image_id", "places", "codes").mapInArrow(_bucketed_with_tests, "image_id long, bucket long, shape long")
    met = _met(buckets, BLOCK)
    pairs = materialize(_compared(_pairs(met, BLOCK)), "meetings")
    discard(met)

    ends = pairs.select("u", "v", F.col("u").alias("image_id")).union(pairs.select("u", "v", F.col("v").alias("image_id")))
    picture = F.struct("places", "codes")
    sides = [F.min(F.when(F.col("image_id") == F.col(end), picture)).alias(name) for end, name in (("u", "left"), ("v", "right"))]
    both = ends.join(reps, "image_id").groupBy("u", "v").agg(*sides)
    links = materialize(both.mapInPandas(_verified, "u long, v long, agreeing long"), "links")
    discard(pairs)
    labels = connected_components(links.select("u", "v"))
    degree = links.select(F.explode(F.array("u", "v")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    answer = (
        seen.select("image_id", "key", "n_corners")
        .join(classes, "key", "left")
        .join(labels.withColumnsRenamed({"id": "rep", "component": "label"}), "rep", "left")
        .join(degree, "rep", "left")
        .select("image_id", "n_corners", F.when(F.col("image_id").isNotNull(), F.coalesce("label", "rep", "image_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    return answer.withColumn("kept", F.col("image_id").eqNullSafe(F.col("component_id")))


#: Side of a made picture, and its grids of random gray with their weights: coarse and fine, as natural pictures have both.
SIDE, GRIDS = 112, ((12, 0.5), (24, 1.0))


def turned(picture: np.ndarray, degrees: float) -> np.ndarray:
    """A picture turned about its middle within its frame, gray outside."""
    h, w = picture.shape
    y, x = np.mgrid[:h, :w] - np.array([h - 1, w - 1])[:, None, None] / 2
    c, s = np.cos(np.deg2rad(degrees)), np.sin(np.deg2rad(degrees))
    fy, fx = c * y - s * x + (h - 1) / 2, s * y + c * x + (w - 1) / 2
    outside = (fy < 0) | (fx < 0) | (fy > h - 1) | (fx > w - 1)
    iy, ix = np.clip(fy.astype(int), 0, h - 2), np.clip(fx.astype(int), 0, w - 2)
    fy, fx = fy - iy, fx - ix
    value = (picture[iy, ix] * (1 - fx) + picture[iy, ix + 1] * fx) * (1 - fy) + (picture[iy + 1, ix] * (1 - fx) + picture[iy + 1, ix + 1] * fx) * fy
    return np.where(outside, 128, np.rint(value)).astype(np.uint8)


def edited(picture: np.ndarray, kind: int, draw: np.random.Generator) -> np.ndarray:
    """An edited copy: cropped, brightened, turned square, covered in part, turned by any angle, resized, noisy, or cropped to about half."""
    h, w = picture.shape
    if kind == 0:
        return picture[h // 14 : h - h // 14, w // 9 : w - w // 12]
    if kind == 1:
        return np.rint(picture * 0.75 + 30).astype(np.uint8)
    if kind == 2:
        return np.rot90(picture, 1 + int(draw.integers(3)))
    if kind == 3:
        out = picture.copy()
        out[h // 2 : h * 3 // 4, w // 6 : w // 2] = 200
        return out
    if kind == 4:
        return turned(picture, float(draw.uniform(5, 355)))
    if kind == 5:
        scale = float(draw.uniform(0.6, 1.4))
        return np.clip(np.rint(resizing(h, scale) @ picture.astype(np.float32) @ resizing(w, scale).T), 0, 255).astype(np.uint8)
    if kind == 6:
        return np.clip(np.rint(picture + draw.normal(0, 8, picture.shape)), 0, 255).astype(np.uint8)
    y, x = (int(n) for n in draw.integers(0, [h * 3 // 10, w * 3 // 10]))
    return picture[y : y + h * 7 // 10, x : x + w * 7 // 10]


def _spread(cells: int) -> np.ndarray:
    """The matrix that draws a line of ``cells`` values out to a line of SIDE pixels."""
    at = (np.arange(SIDE) + 0.5) / SIDE * cells - 0.5
    return np.maximum(0, 1 - np.abs(np.arange(cells) - np.clip(at, 0, cells - 1)[:, None])).astype(np.float32)


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A picture for each vector, and for every fourth picture an edited copy; both depend on the vector's values alone."""
    spreads = [(_spread(cells), cells, weight / sum(w for _, w in GRIDS)) for cells, weight in GRIDS]
    for batch in batches:
        out = []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = np.array([x for x in v or [] if x is not None], np.float32).tobytes()
            seed = int.from_bytes(hashlib.sha256(data).digest()[:8], "little")
            draw = np.random.default_rng(seed)
            picture = np.rint(255 * sum(weight * (m @ draw.random((cells, cells), np.float32) @ m.T) for m, cells, weight in spreads)).astype(np.uint8)
            out.append((None if i is None else 2 * i, picture))
            if seed % 4 == 0:
                out.append((None if i is None else 2 * i + 1, edited(picture, seed // 4 % 8, draw)))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in out], pa.int64()), pa.array([p.shape[1] for _, p in out], pa.int32()), pa.array([p.shape[0] for _, p in out], pa.int32()), pa.array([p.tobytes() for _, p in out], pa.binary())],
                names=["image_id", "width", "height", "pixels"],
            )


def pictures_of(vectors: DataFrame) -> DataFrame:
    """The pictures that the media query works on, made from ``vectors(vec_id, embedding)``: image 2n of vector n, and 2n + 1 its edited copy, if any."""
    return vectors.select("vec_id", "embedding").mapInArrow(_rendered, "image_id long, width int, height int, pixels binary")
