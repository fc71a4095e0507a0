import numpy as np

from corvane.llm.media import agreeing, describe, image_copies, pictures_of

SF = "/root/testdata/sf0.001"


def test_edited_copies_are_found(spark):
    """Brute force: image 2n + 1 is an edited copy of 2n, and equal vectors make equal pictures; all others are strangers."""
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").limit(160)
    again = vectors.limit(5).selectExpr("vec_id + 100000 as vec_id", "embedding", "label")
    pictures = pictures_of(vectors.union(again)).persist()
    pixels = {r.image_id: (r.width, bytes(r.pixels)) for r in pictures.collect()}
    first = {}
    for i in sorted(pixels):
        first.setdefault(pixels[i], i)
    want = {i: first[pixels[i // 2 * 2]] for i in pixels}
    got = {r.image_id: r for r in image_copies(pictures).collect()}
    copies = [i for i in pixels if i % 2]
    assert len(copies) > 20 and set(got) == set(pixels)
    missed = [i for i in copies if got[i].component_id != want[i]]
    assert len(missed) <= 0.05 * len(copies)
    assert all(got[i].component_id == want[i] for i in pixels if i % 2 == 0)
    pictures.unpersist()


def test_turned_picture():
    a = np.rint(np.kron(np.random.default_rng(3).random((20, 20)) * 255, np.ones((6, 6)))).astype(np.uint8)
    (pa, ca), (pb, cb) = describe(a), describe(np.rot90(a))
    i, j = zip(*[(i, j) for i in range(len(ca)) for j in range(len(cb)) if np.bitwise_count((ca[i] ^ cb[j]).view(np.uint64)).sum() <= 40], strict=True)
    assert agreeing(pa[list(i)], pb[list(j)]) >= 10


def test_edges(spark):
    flat, tiny = b"\x07" * 10_000, b"\x01\x02"
    rows = [(1, 100, 100, flat), (2, 100, 100, flat), (3, 2, 1, tiny), (4, 9, 9, tiny), (5, None, 1, None), (None, 100, 100, flat), (6, 0, 0, b""), (7, 2, 1, tiny)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "image_id long, width int, height int, pixels binary, key string")
    got = {r.image_id: (r.component_id, r.n_links, r.kept) for r in image_copies(df).collect()}
    assert got == {1: (1, 0, True), 2: (1, 0, False), 3: (3, 0, True), 4: (4, 0, True), 5: (5, 0, True), 6: (6, 0, True), 7: (3, 0, False), None: (None, 0, True)}
    assert image_copies(df.limit(0)).collect() == []
