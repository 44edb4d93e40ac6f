import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

from tests.conftest import SF
from tests.llm import odd
from ticketgrain.llm import importance_resampling, queries
from ticketgrain.llm.importance_resampling import GramTable, Occurrences, lower_cut, resample


def features(text, n=1):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return len(words), [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, percent=10, least=20, n=1, buckets=10_000, seed=2024):
    place = lambda f: zlib.crc32(f.encode()) % buckets
    raw = Counter(place(f) for _, t in docs for f in features(t, n)[1])
    aim = Counter(place(f) for t in target for f in features(t, n)[1])
    s_all, t_all = raw.total(), aim.total()
    rows = []
    for doc_id, text in docs:
        words, grams = features(text, n)
        weight = sum(
            math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets)))) for b in map(place, grams)
        )
        h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((words, (doc_id, len(grams), weight, score)))
    fit = sorted((r for w, r in rows if w >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = fit[: percent * len(fit) // 100]
    out = Counter((*r, k) for k, r in enumerate(drawn, 1))
    rest = Counter(r for _, r in rows)
    rest.subtract(Counter(drawn))
    return out + Counter({(*r, None): n for r, n in rest.items()})


def target_table(spark, texts):
    return spark.createDataFrame([(t, "?") for t in texts], "text string, weight string")


TARGET = ["A river and a hill, and the river again", None, "", "Ünïcödé 漢字"]


def check(spark, docs, target, **options):
    names = {"draw_percent": "percent", "min_words": "least", "max_gram": "n"}
    found = resample(odd.table(spark, docs), target_table(spark, target), **options)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert odd.bag(found) == brute(docs, target, **{names[k]: v for k, v in options.items()})


def test_odd_tables(spark):
    check(spark, odd.ROWS, TARGET)
    check(spark, odd.ROWS, TARGET, draw_percent=100, min_words=1)
    check(spark, odd.ROWS, TARGET, draw_percent=60, min_words=0, max_gram=3)
    check(spark, odd.ROWS, [], draw_percent=50, min_words=2)
    empty = resample(odd.empty(spark), target_table(spark, TARGET))
    assert empty.count() == 0
    check(spark, [(1, None), (2, "a b")], TARGET)


def test_ties_and_a_group_of_copies(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 40)))) for i in range(200)] + [(None, "a b c " * 9)] * 150
    for percent in (0, 1, 33, 100):
        check(spark, docs, ["a a b"], draw_percent=percent)


def test_table_verifies_bytes():
    """With hashes of four values all n-grams collide; counts and buckets stay those of each n-gram."""
    rng = random.Random(1)
    grams = [f"g{rng.randint(0, 400)}".encode() for _ in range(5000)]
    for hashed in (xxhash.xxh64_intdigest, lambda g: len(g) % 4, lambda g: 2**64 - 1):
        table = GramTable(97, slots=8, hashed=hashed)
        found = []
        for start in range(0, len(grams), 700):
            slots = table.intern(grams[start : start + 700])
            found += table.bucket[slots].tolist()
            assert table.grams[slots].tolist() == grams[start : start + 700]
        assert found == [zlib.crc32(g) % 97 for g in grams]
        held = {table.grams[i]: int(table.count[i]) for i in np.flatnonzero(table.count)}
        assert held == Counter(grams) and table.used == len(held) and 2 * table.used <= len(table.keys)
        assert table.by_bucket().tolist() == [sum(n for g, n in held.items() if zlib.crc32(g) % 97 == b) for b in range(97)]


def test_long_texts_are_cut_between_words(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["Ab", "c", "dÉf", "1-2", "\n", "x" * 50], k=k)) for k in (0, 1, 40, 300)] + [""]
    for n in (1, 2, 4):
        wanted = [features(t, n) for t in texts]
        for size in (1, 7, 64, 1 << 20):
            monkeypatch.setattr(importance_resampling, "_PIECE", size)
            monkeypatch.setattr(importance_resampling, "_CHUNK", size)
            found = Occurrences([t.encode() for t in texts], n)
            held = [Counter() for _ in texts]
            for docs, grams in found:
                for i, g in zip(docs, grams, strict=True):
                    held[i][g.decode()] += 1
            assert held == [Counter(grams) for _, grams in wanted]
            assert found.n_words.tolist() == [w for w, _ in wanted] and found.n_grams.tolist() == [len(g) for _, g in wanted]


def test_cut(spark):
    rng = random.Random(2)
    for scores in ([5], [3] * 50, [rng.randint(-(10**12), 10**12) for _ in range(500)], [rng.randint(0, 3) for _ in range(300)]):
        df = spark.createDataFrame([(s,) for s in scores], "score long")
        for drawn in {1, len(scores) // 3 or 1, len(scores)}:
            cut, last = lower_cut(df, drawn), sorted(scores, reverse=True)[drawn - 1]
            assert cut <= last and sum(s >= cut for s in scores) <= drawn + scores.count(last)
    assert lower_cut(df, 0) > max(scores) and lower_cut(df.limit(0), 3) > 0


def test_whole_table(spark):
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = odd.bag(queries.op12_importance_resampling(spark, SF))
    assert found == brute(odd.sf_texts(spark, SF), target)
