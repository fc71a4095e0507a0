"""Strangers whose corners happen to fall into one bucket don't meet, as their number grows with the square of the pictures'."""

import numpy as np
from pyspark.sql import functions as F

from corvane.llm import media


def test_strangers_hardly_meet(spark):
    vectors = spark.range(2000).select(F.col("id").alias("vec_id"), F.array([F.rand(seed=n).cast("float") for n in range(4)]).alias("embedding"))
    seen = media.pictures_of(vectors).mapInArrow(media._described, media._SEEN).select("image_id", "places", "codes").persist()
    edits = [r[0] for r in seen.where("image_id % 2 = 1").select("image_id").collect()]
    met = media._meetings(seen.mapInArrow(media._bucketed, "image_id long, bucket long, shape int")).groupBy("u", "v").count().collect()
    strangers = sum(r["count"] for r in met if r.u // 2 != r.v // 2)
    found = {r.v for r in met if r.u + 1 == r.v and r.u % 2 == 0}
    assert len(edits) > 400 and len(found) >= 0.97 * len(edits)
    assert strangers <= 0.01 * sum(r["count"] for r in met)
    seen.unpersist()


def test_shapes(spark):
    """Two corners lie alike in a turned, resized and shifted picture; near the ends of the 256 steps too."""
    draw = np.random.default_rng(7)
    a = np.concatenate([draw.uniform(0, 300, (80, 2)), np.ones((80, 1)), draw.uniform(-np.pi, np.pi, (80, 1))], 1)
    turn, size = 2.2, 0.595
    c, s = np.cos(turn) / size, np.sin(turn) / size
    b = np.concatenate([a[:, :2] @ np.array([[c, s], [-s, c]]) + 40, np.full((80, 1), size), np.angle(np.exp(1j * (a[:, 3:] + turn)))], 1)
    one, other = media.beside(a)
    assert len(one) == 80 * media.BESIDE and (one != other).all()
    for i in range(80):
        near = np.argsort(np.hypot(*(a[:, :2] - a[i, :2]).T))[1 : 1 + media.BESIDE]
        assert set(other[one == i]) == set(near)
    rows = list(zip(media.shapes(a, one, other).tolist(), media.shapes(b, one, other).tolist(), media.shapes(a, other, one).tolist(), strict=True))
    df = spark.createDataFrame(rows, "a int, b int, c int")
    alike = df.select(media.shapes_alike("a", "b").alias("same"), media.shapes_alike("a", "c").alias("else")).collect()
    assert all(r["same"] for r in alike) and sum(r["else"] for r in alike) < 24
    assert [x.tolist() for x in media.beside(a[:1])] == [[0], [0]] and media.shapes(a, np.array([0]), np.array([0])).tolist() == [0]
