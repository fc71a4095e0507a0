import hashlib

import numpy as np

from corvane.llm.media import describe, edited, image_copies, linked, pictures_of, turned

SF = "/root/testdata/sf0.01"


def test_links_against_all_pairs(spark):
    """Brute force: every two pictures compared corner by corner; tables may lose a tenth of such links, and add none."""
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id < 110")
    pictures = pictures_of(vectors).collect()
    shown = {}
    for p in sorted(pictures, key=lambda p: p.image_id):
        image = np.frombuffer(bytes(p.pixels), np.uint8).reshape(p.height, p.width)
        shown.setdefault((p.width, bytes(p.pixels)), (p.image_id, describe(image)))
    some = list(shown.values())
    links = {(i, j) for n, (i, a) in enumerate(some) for j, b in some[n + 1 :] if linked(a, b)}
    got = {r.image_id: r for r in image_copies(spark.createDataFrame(pictures)).collect()}
    found = {(i, j) for i, j in links if got[i].component_id == got[j].component_id}
    assert len(links) > 15 and len(found) >= 0.9 * len(links)
    reach = {}
    for i, j in links:
        reach.setdefault(i, set()).add(j)
        reach.setdefault(j, set()).add(i)
    first = {i: i for i, _ in some}
    for _ in some:
        first = {i: min([c, *(first[j] for j in reach.get(i, ()))]) for i, c in first.items()}
    ids = {key: i for key, (i, _) in shown.items()}
    for p in pictures:
        assert got[p.image_id].component_id >= first[ids[p.width, bytes(p.pixels)]]


def test_recall_over_a_whole_table(spark):
    """All planted edits of a table, of whatever kind: crops to half, turns by any angle, resizes from 0.6 to 1.4, noise, brightness, cover."""
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = {r.image_id: r.component_id for r in image_copies(pictures_of(vectors)).collect()}
    first = {}
    for v in sorted(vectors.collect(), key=lambda v: v.vec_id):
        first.setdefault(hashlib.sha256(np.array(v.embedding, np.float32).tobytes()).digest(), []).append(v.vec_id)
    original = {i: 2 * ids[0] for ids in first.values() for i in ids}
    copies = [i for i in got if i % 2]
    assert len(copies) > 90
    assert np.mean([got[i] == original[i // 2] for i in copies]) >= 0.9
    assert all(got[i] == original[i // 2] for i in got if i % 2 == 0)


def test_each_kind_of_edit():
    draw = np.random.default_rng(5)
    cells = np.kron(draw.random((30, 30)) * 255, np.ones((5, 5)))
    picture = np.rint((cells[:-2, :-2] + cells[1:-1, 1:-1] + cells[2:, 2:]) / 3).astype(np.uint8)
    a = describe(picture)
    for copy in [edited(picture, k, draw) for k in range(8)] + [turned(picture, d) for d in (10, 30, 45, 77)]:
        assert linked(a, describe(np.ascontiguousarray(copy)))
    other = np.rint(np.kron(draw.random((30, 30)) * 255, np.ones((5, 5)))).astype(np.uint8)
    assert not linked(a, describe(other))
