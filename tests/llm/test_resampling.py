import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from corvane.llm.ranking import global_ranks
from corvane.llm.resampling import bucket_ids, collapsed, importance_resample, scanners
from pyspark.sql import functions as F

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(CAPITALS))
    return w, [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def by_hand(docs, target, buckets, longest, least, percent, seed):
    def bucket(f):
        return crc32(f.encode()) % buckets

    own = [(i, *features(t, longest)) for i, t in docs]
    s, t = Counter(bucket(f) for _, _, fs in own for f in fs), Counter(bucket(f) for x in target for f in features(x, longest)[1])
    all_s, all_t = s.total() + buckets, t.total() + buckets
    out = []
    for i, w, fs in own:
        weight = sum(math.floor(1000 * math.log((t[bucket(f)] + 1) * all_s / ((s[bucket(f)] + 1) * all_t))) for f in fs)
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] if r[0] is not None else -1))
    rank = {id(r): k for k, r in enumerate(able[: percent * len(able) // 100], 1)}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=str)


@pytest.mark.parametrize("longest", [1, 3])
def test_against_the_rule(spark, longest):
    draw = random.Random(longest)
    words = ["Apple", "bär", "x1", "THE", "the", "ÄPFEL", "日本", "q" * 40, "9"]
    docs = [(i, "".join(draw.choice(words) + draw.choice([" ", "  ", ", ", "\n", "\x00", "--"]) for _ in range(draw.randint(0, 60)))) for i in range(300)]
    docs += [(7, docs[7][1]), (None, "the apple " * 15), (1000, None), (1001, ""), (1002, " .,; "), (1003, "the " * 50_000)]
    target = [docs[3][1], "apple the bär " * 30, None, ""]
    df = spark.createDataFrame([(*d, 5, "w") for d in docs], "doc_id long, text string, score int, rank string").repartition(5)
    got = importance_resample(df, spark.createDataFrame([(t,) for t in target], "text string"), buckets=97, longest=longest)
    rows = sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()), key=str)
    assert rows == by_hand(docs, target, 97, longest, 20, 10, 2024)
    assert dict(got.dtypes) == {c: "bigint" for c in ("doc_id", "n_features", "weight", "score", "rank")}


def test_spans(spark):
    patterns = scanners(3)
    text = collapsed("  One, two\tTWO…three ".encode())
    assert text == "one two two…three".encode()
    assert [[m[0].decode() for m in p.finditer(text, overlapped=True)] for p in patterns] == [["one", "two", "two…three"], ["one two", "two two…three"], ["one two two…three"]]
    assert bucket_ids(text, patterns, 10).tolist() == [crc32(f.encode()) % 10 for f in ("one", "two", "two…three", "one two", "two two…three", "one two two…three")]
    assert not len(bucket_ids(b"", patterns, 10))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert importance_resample(none, none).collect() == []
    some = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    assert [(r.n_features, r["rank"]) for r in importance_resample(some, none).collect()] == [(30, None)]


def test_ranks_of_a_table_with_one_crowded_key(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 50).alias("key")).repartition(7)
    got = [r.place for r in global_ranks(rows, [F.col("key").desc()], "place").orderBy("place").collect()]
    keys = [r.key for r in global_ranks(rows, [F.col("key").desc()], "place").orderBy("place").collect()]
    assert got == list(range(1, 3001)) and keys == sorted(keys, reverse=True)
