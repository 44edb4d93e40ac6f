from tests.conftest import SF
from tests.llm import odd
from tests.llm.plain_quality import quality as plain
from ticketgrain.llm import queries
from ticketgrain.llm.quality_rules import keep_good, quality
from tools.check_queries import duck


def rounded(rows):
    return odd.Counter(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)


def sf_rows(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]


def test_whole_table(spark):
    assert rounded(queries.op6_quality_rules(spark, SF).collect()) == rounded(plain(sf_rows(spark, SF)))


def test_sql(spark):
    found = duck(SF).execute(queries.ORACLES["op6_quality_rules"])
    columns = [c[0] for c in found.description]
    df = queries.op6_quality_rules(spark, SF)
    assert sorted(columns) == sorted(df.columns)
    assert rounded(found.fetchall()) == rounded(df.select(*columns).collect())


REPEATS = [
    "a b c d e a b c d e",
    "a b c d e f g h i j k l m n o p q r s t u v w x y z a b c d e",
    " ".join(["same"] * 40),
    "one two three four five six seven eight nine ten eleven",
    "l1\nl1\n \nl1 \n\t\nl2\nl2",
    "x y z " * 3 + "p q",
]


def test_odd_rows(spark):
    rows = [(i, t, "en") for i, t in odd.ROWS + list(enumerate(REPEATS, 200))]
    docs = odd.table(spark, [(i, t) for i, t, _ in rows])
    assert rounded(quality(docs).collect()) == rounded(plain(rows))
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert odd.bag(kept, "doc_id", "text") == odd.Counter((r[0], r[1]) for r, p in zip(rows, plain(rows)) if p[-1])
    assert quality(odd.empty(spark)).count() == 0 and keep_good(odd.empty(spark)).count() == 0
    without = docs.select("doc_id", "text")
    assert quality(without).filter("class_distance is not null").count() == 0


def test_planted(spark):
    """Clean prose stays, noise goes, and unknown languages are left to the base rules."""
    clean = [(i, f"The story of the {i} is that it was in the house by the river and with a man from the town. " + t, "en")
             for i, t in enumerate(" ".join(f"name{(i * k) % 97} of the" for k in range(30)) for i in range(1, 41))]
    shout = (900, " ".join(f"WORD{chr(65 + i % 26)}{chr(65 + i // 26)}!!" for i in range(80)), "en")
    marks = (901, " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}###" for i in range(80)), "en")
    other = (902, shout[1], "xx")
    schema = "doc_id long, text string, lang string"
    rows = clean + [shout, marks, other]
    found = {r.doc_id: r.kept for r in quality(spark.createDataFrame(rows, schema)).collect()}
    wanted = {r[0]: r[-1] for r in plain(rows)}
    assert found == wanted
    assert not found[900] and not found[901] and found[902] and all(found[i] for i, *_ in clean)


def test_languages(spark):
    """Rows without a language are tested, those of other languages are not; one document makes a reference."""
    prose = " ".join(f"the house{chr(97 + i)} and the man{chr(97 + i)} of a town{chr(97 + i)} in it" for i in range(20))
    noise = " ".join(f"W{i}!!{i}#" for i in range(90))
    rows = [(1, prose, "en"), (2, noise, None), (3, prose + "once more", None), (4, noise, "xx"), (5, prose, "fr"), (6, noise, "")]
    found = quality(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert rounded(found.collect()) == rounded(plain(rows))
    only = quality(spark.createDataFrame(rows[1:4], "doc_id long, text string, lang string")).collect()
    assert all(r.class_distance is None for r in only)
    kept = {r.doc_id: (r.kept, r.class_distance is not None) for r in found.collect()}
    assert kept[2] == (False, True) and kept[4] == (True, False) and kept[6] == (True, False) and kept[5][1]
