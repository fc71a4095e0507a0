"""All pictures of a bucket meet, whatever its size."""

from collections import Counter
from itertools import combinations

from corvane.llm import media


def test_all_pictures_of_a_bucket_meet(spark):
    groups = {1: range(10, 33), 2: [3, 1, 2], 3: [7], 4: [5, 6]}
    rows = [(i, b) for b, ids in groups.items() for i in ids]
    got = Counter((r.u, r.v) for r in media._meetings(spark.createDataFrame(rows, "image_id long, bucket long"), block=4).collect())
    assert got == Counter(pair for ids in groups.values() for pair in combinations(sorted(ids), 2))
