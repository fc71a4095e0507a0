"""What is compared corner by corner: copies, hardly any strangers; and the comparison counts as its plain form does."""

from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from corvane.llm import media


def test_few_strangers_are_compared(spark):
    vectors = spark.range(4000).select(F.col("id").alias("vec_id"), F.array([F.rand(seed=n).cast("float") for n in range(4)]).alias("embedding"))
    seen = media.pictures_of(vectors).mapInArrow(media._described, media._SEEN).select("image_id", "places", "codes").persist()
    edits = seen.where("image_id % 2 = 1").count()
    met = media._meetings(seen.mapInArrow(media._bucketed_with_tests, "image_id long, bucket long, shape long")).persist()
    before = {(r.u, r.v) for r in met.select("u", "v").distinct().collect()}
    after = {(r.u, r.v) for r in media._compared(met).collect()}
    copies, strangers = ({(u, v) for u, v in before if (u // 2 == v // 2) == same} for same in (True, False))
    assert after <= before and len(copies) >= 0.96 * edits
    assert len(copies - after) <= 0.005 * len(copies)
    assert len(strangers) > 50 and len(strangers & after) <= 0.3 * len(strangers)
    met.unpersist()
    seen.unpersist()


def test_rows_of_crowded_and_small_buckets_meet_once(spark):
    """Blocks of three: within reach, across blocks and in buckets of every size around the block's."""
    rows = [(i, b, i << 24) for b in range(1, 12) for i in range(b)]
    got = Counter((r.u, r.v, r.differ) for r in media._meetings(spark.createDataFrame(rows, "image_id long, bucket long, shape long"), block=3).collect())
    assert got == Counter((u, v, (u ^ v).bit_count()) for b in range(1, 12) for u, v in combinations(range(b), 2))


def test_once_or_more(spark):
    df = spark.createDataFrame([(1, 2, 5), (1, 3, 4), (1, 4, 30), (1, 4, 31), (2, 4, 32)], "u long, v long, differ int")
    assert sorted((r.u, r.v) for r in media._compared(df).collect()) == [(1, 3), (1, 4)]


def test_agreeing_as_counted_one_by_one():
    draw = np.random.default_rng(11)

    def one_by_one(a, b):
        best, turn, size = 0, b[:, 3] - a[:, 3], a[:, 2] / b[:, 2]
        for t, s, origin_a, origin_b in zip(turn, size, a[:, :2], b[:, :2], strict=True):
            c, n = np.cos(t) * s, np.sin(t) * s
            moved = (a[:, :2] - origin_a) @ np.array([[c, n], [-n, c]]) + origin_b
            near = (np.abs(moved - b[:, :2]).max(1) <= media.SHIFT * max(1, s)) & (np.abs(np.angle(np.exp(1j * (turn - t)))) < 0.35) & (np.abs(np.log2(size / s)) < 0.3)
            best = max(best, min(len({tuple(p) for p in np.rint(x[near, :2] / 4)}) for x in (a, b)))
        return best

    for n in (1, 7, 60, 700):
        a = np.concatenate([draw.uniform(0, 112, (n, 2)), draw.choice(media.SCALES, (n, 1)), draw.uniform(-np.pi, np.pi, (n, 1))], 1)
        b = a.copy()
        b[::2, :2] = draw.uniform(0, 112, (len(b[::2]), 2))
        b[:, 2:] = a[draw.permutation(n) if n > 60 else np.arange(n), 2:]
        b[:, 3] += draw.normal(1, 0.2, n)
        assert media.agreeing(a, b) == one_by_one(a, b) > 0
    assert media.agreeing(a[:0], b[:0]) == 0
