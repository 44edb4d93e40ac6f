"""SimHash groups and line deduplication against loops over all pairs."""

import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm import odd
from ticketgrain.llm import queries
from ticketgrain.llm.line_dedup import (
    MIN_WORDS, content_lines, dedup_lines, delete_lines, drop_repeated_lines, run_ends, run_starts, windows_around, winnow,
)
from ticketgrain.llm.simhash import components, keep_one, near_duplicates, simhash
from tools.check_queries import duck

ASCII = " \t\n\x0b\x0c\r"


def plain_simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in ASCII[1:]:
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    prints = [plain_simhash(t) for _, t in rows]
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    low = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            low[find(p)] = min(low.get(find(p), doc_id), doc_id)
    return odd.Counter((i, f"{p:016x}", low.get(find(p))) for (i, _), p in zip(rows, prints)), {find(p) for p in prints}


def near_rows():
    random.seed(11)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for group in range(12):
        text = [random.choice(words) for _ in range(400)]
        for copy in range(random.randint(1, 12)):
            changed = list(text)
            for _ in range(copy % 5):
                changed[random.randrange(400)] = "changed"
            rows.append((len(rows) * 7 % 101, " ".join(changed)))
    return rows


def test_simhash_value():
    for _, text in odd.ROWS + near_rows()[:10]:
        assert simhash((text or "").encode()) % 2**64 == plain_simhash(text)


def test_groups(spark):
    rows = odd.ROWS + near_rows()
    wanted, roots = plain_groups(rows)
    docs = odd.table(spark, rows)
    assert odd.bag(near_duplicates(docs)) == wanted
    kept = keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(roots)
    assert len({plain_groups([(r.doc_id, r.text)])[1].pop() for r in kept.collect()} - roots) == 0 or len(roots) == kept.count()
    assert near_duplicates(odd.empty(spark)).count() == 0 and keep_one(odd.empty(spark)).count() == 0


def test_groups_whole_table(spark):
    wanted, roots = plain_groups(odd.sf_texts(spark, SF))
    assert odd.bag(queries.op9_simhash(spark, SF)) == wanted


def test_every_pair_of_bits_meets(spark):
    """Fingerprints two flipped bits apart link for all 2016 pairs of bits, three apart never."""
    from ticketgrain.llm.simhash import links

    base = 0x0123456789ABCDEF
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    rows = [(signed(base),)] + [(signed(base ^ 1 << a ^ 1 << b),) for a in range(64) for b in range(a)]
    nodes = spark.createDataFrame(rows, "fp long")
    found = components(links(nodes))
    assert found.count() == 2017 and found.select("root").distinct().count() == 1
    apart = spark.createDataFrame([(0,), (7,), (7 << 20,)], "fp long")
    assert links(apart).count() == 0


def test_segment_tables_at_other_distances(spark):
    """The same components as all pairs, through small entries, crowded ones, and both."""
    from ticketgrain.llm.simhash import links

    rng = random.Random(8)
    flipped = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    prints = {0, 2**64 - 1, 2**63}
    for _ in range(12):
        base = rng.getrandbits(64)
        prints.update([base, *(flipped(base, rng.randint(1, 6)) for _ in range(6))])
    signed = {x - 2**64 if x >= 2**63 else x: x for x in prints}
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    for bits, segments, entry in ((1, 4, 8), (2, 2, 8), (2, 4, 1), (2, 2, 0), (3, 2, 8), (3, 4, 1), (3, 2, 0), (5, 4, 8)):
        root = {x: x for x in prints}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= bits:
                    root[find(a)] = find(b)
        wanted = {}
        for x in prints:
            wanted.setdefault(find(x), set()).add(x)
        found = {}
        for r in components(links(nodes, bits, segments, entry)).collect():
            found.setdefault(r.root, set()).add(signed[r.node])
        assert {frozenset(g) for g in found.values()} == {frozenset(g) for g in wanted.values() if len(g) > 1}, (bits, segments, entry)
    with pytest.raises(ValueError):
        links(nodes, segments=3)


def test_components(spark):
    random.seed(2)
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (200, 201), (201, 202), (202, 200)]
    star = [(500, 1000 + i) for i in range(60)]
    edges = spark.createDataFrame(random.sample(chain + star, len(chain + star)), "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    wanted = {i: 0 for i in range(41)} | {i: 90 for i in (90, 95, 100)} | {i: 200 for i in (200, 201, 202)}
    assert found == wanted | {500: 500} | {1000 + i: 500 for i in range(60)}
    assert components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("few", [0, 100_000])
def test_components_by_joins_and_by_lookups(spark, few):
    """Both ways give the components of a plain union of all edges; repeated edges and either order are allowed."""
    rng = random.Random(5)
    ids = [rng.randrange(-(2**63), 2**63) for _ in range(120)]
    hub = [(ids[0], x) for x in ids[1:30]] + [(max(ids), x) for x in ids[30:50] if x != max(ids)]
    pairs = hub + list(zip(ids[50:80], ids[51:81])) + [tuple(rng.sample(ids[85:], 2)) for _ in range(30)]
    pairs += pairs[::5] + [(b, a) for a, b in pairs[::7]]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    found = [tuple(r) for r in components(spark.createDataFrame(pairs, "a long, b long"), few).collect()]
    assert sorted(found) == sorted((x, find(x)) for x in root)


def test_groups_stage_few_tables(spark, monkeypatch):
    """A drifting group, whose members differ from the next in one word, and a crowded one."""
    from ticketgrain.llm import simhash as module

    names, staged = [], module.staged
    monkeypatch.setattr(module, "staged", lambda df, name: names.append(name) or staged(df, name))
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    text, rows = [rng.choice(words) for _ in range(300)], []
    for doc_id in range(60):
        text = [*text]
        text[rng.randrange(300)] = "changed"
        rows.append((doc_id, " ".join(text)))
    text = [rng.choice(words) for _ in range(3000)]
    for doc_id in range(60, 100):
        rows.append((doc_id, " ".join([*text[: 50 * (doc_id - 60)], "other", *text[50 * (doc_id - 60) :]])))
    wanted, _ = plain_groups(rows)
    assert odd.bag(near_duplicates(odd.table(spark, rows))) == wanted
    assert names[:2] == ["fingerprints", "fingerprint-nodes"] and set(names[2:]) == {"edges"} and len(names) <= 7, names


def test_few_edges_are_contracted_in_two_shuffles(spark, tmp_path):
    from ticketgrain.llm.simhash import contracted

    spark.createDataFrame([(2, 1), (3, 2), (3, 2)], "a long, b long").write.parquet(str(tmp_path / "edges"))
    edges = spark.read.parquet(str(tmp_path / "edges"))
    few = contracted(edges, True)
    found = few.collect()
    assert {tuple(r) for r in found} == {(2, 1), (3, 1)} and len(found) == 3
    assert sorted(tuple(r) for r in contracted(edges, False).collect()) == [(2, 1), (3, 1)]
    plan = few._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 5  # two pointers, twice, and the minima


def test_tables_that_grow_are_merged(spark, tmp_path):
    """A ball has 66 rows for each fingerprint, of which the planner's sizes know nothing: no plan may broadcast by them."""
    from ticketgrain.llm.simhash import contracted, links

    spark.range(2000).select(F.xxhash64("id").alias("fp")).write.parquet(str(tmp_path / "nodes"))
    spark.range(2000).selectExpr("id + 1 AS a", "id DIV 2 AS b").write.parquet(str(tmp_path / "edges"))
    nodes, edges = (spark.read.parquet(str(tmp_path / name)) for name in ("nodes", "edges"))
    for df in (links(nodes), contracted(edges, False), near_duplicates(odd.table(spark, near_rows()))):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert links(nodes).count() == 0


# --- lines ---------------------------------------------------------------------
def plain_dedup(rows, least):
    """Every run with enough words whose content stands at an earlier place is marked."""
    signed = lambda t: xxhash.xxh64_intdigest(t.encode(), 42)
    order = sorted(
        range(len(rows)),
        key=lambda i: (-(2**63) if rows[i][0] is None else rows[i][0], (signed(rows[i][1] or "") ^ 1 << 63), i),
    )
    lines = {i: [(p, tuple(x.encode().split())) for p, x in enumerate((rows[i][1] or "").split("\n")) if x.encode().split()] for i in order}
    seen, result = set(), {}
    marked = {i: set() for i in order}
    for i in order:
        units = [u for _, u in lines[i]]
        for a in range(len(units)):
            words = 0
            for b in range(a, len(units)):
                words += len(units[b])
                if words >= least:
                    run = tuple(units[a : b + 1])
                    if run in seen:
                        marked[i].update(range(a, b + 1))
                    seen.add(run)
    for i in order:
        text = rows[i][1] or ""
        places = [p for p, _ in lines[i]]
        drop = {places[u] for u in marked[i]}
        for u in marked[i]:
            if u + 1 in marked[i]:
                drop.update(range(places[u], places[u + 1]))
        kept = "\n".join(x for p, x in enumerate(text.split("\n")) if p not in drop)
        result[i] = (rows[i][0], text.count("\n") + 1, len(drop), sum(len(lines[i][u][1]) for u in marked[i]), kept)
    return odd.Counter(result.values())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=25), st.integers(1, 20))
def test_runs(counts, least):
    for i, end in enumerate(run_ends(counts, least)):
        ends = [e for e in range(i, len(counts)) if sum(counts[i : e + 1]) >= least]
        assert end == (min(ends) if ends else None)
    for j, start in enumerate(run_starts(counts, least)):
        starts = [s for s in range(j + 1) if sum(counts[s : j + 1]) >= least]
        assert start == (max(starts) if starts else None)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=30), st.integers(2, 9))
def test_every_window_holds_a_selected_gram(kinds, least):
    _, hashes, counts = content_lines("\n".join("w " * (k + 1) + str(k) for k in kinds))
    selected = winnow(hashes, counts, least)
    around = windows_around(counts, selected, least)
    assert {(i, e) for i, e in enumerate(run_ends(counts, least)) if e is not None} <= around


def line_rows():
    random.seed(4)
    lines = [" ".join(random.choice("abcdefgh") + str(k) for _ in range(random.choice((1, 2, 6, 20)))) for k in range(14)]
    lines += ["", " \t", " ".join(f"long{i}" for i in range(60))]
    return [(i, "\n".join(random.choice(lines) for _ in range(random.randint(0, 16)))) for i in range(60)]


def test_lines(spark):
    rows = line_rows() + [(i, t) for i, t in line_rows()[:5]] + odd.ROWS
    docs = odd.table(spark, rows)
    for least in (12, MIN_WORDS):
        assert odd.bag(dedup_lines(docs, least)) == plain_dedup(rows, least)
    changed = drop_repeated_lines(docs)
    assert changed.columns == docs.columns and changed.count() == len(rows)
    assert odd.Counter((r.doc_id, r.text or "") for r in changed.collect()) == odd.Counter(
        {(k[0], k[4]): 0 for k in plain_dedup(rows, MIN_WORDS)}
    ) + odd.Counter([(k[0], k[4]) for k, n in plain_dedup(rows, MIN_WORDS).items() for _ in range(n)])
    assert changed.filter("doc_id = 7").first().text is None
    assert dedup_lines(odd.empty(spark)).count() == 0 and drop_repeated_lines(odd.empty(spark)).count() == 0


def test_lines_whole_table(spark):
    assert odd.bag(queries.op10_line_dedup(spark, SF)) == plain_dedup(odd.sf_texts(spark, SF), MIN_WORDS)


def test_lines_sql(spark):
    found = duck(SF).execute(queries.ORACLES["op10_line_dedup"])
    columns = [c[0] for c in found.description]
    assert odd.Counter(found.fetchall()) == odd.bag(queries.op10_line_dedup(spark, SF), *columns)


def test_delete_lines():
    text = "one\n\ntwo\nthree\n \nfour"
    assert delete_lines(text, [(1, 2)]) == ("one\n\n \nfour", 6, 2, 2)
    assert delete_lines(text, [(0, 1), (1, 1)]) == ("three\n \nfour", 6, 3, 2)
    assert delete_lines("", []) == ("", 1, 0, 0)
