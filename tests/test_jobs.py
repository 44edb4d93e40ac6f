import json

from pyspark.sql import types as T

from tests.conftest import rows
from ticketgrain import jobs, schemas
from ticketgrain.sources import readers

RATINGS = "".join(f", {c} string" for c in ("relevance", "professionalism", "completeness", "tone", "overall", "comments"))


def raw(spark, n=60):
    data = [
        (f"s{i}", f"body {i}", f"answer {i}" if i % 5 else None, "Incident", f"q{i % 2}", "high", "en" if i % 6 else "de",
         *[None] * 8)
        for i in range(n)
    ]
    return spark.createDataFrame(data, schemas.RAW_TICKETS)


def test_from_raw_tickets_to_profile_and_samples(spark, tmp_path):
    source, splits, out = (str(tmp_path / x) for x in ("raw", "splits", "out"))
    raw(spark).write.parquet(source)
    split = jobs.prepare_splits(spark, source, splits)
    assert split.count() == 50
    assert "cleaned_text" in split.columns and "_row" not in split.columns
    classes = jobs.profile(spark, splits, out)
    assert rows(classes, "priority", "n") == [("high", 50)]

    first = jobs.prepare_instructions(spark, splits, out, "response_generation")
    second = jobs.prepare_instructions(spark, splits, out, "multi_task")
    assert (first.count(), second.count()) == (3, 6)
    train = spark.read.json(f"{out}/alpaca_response_generation_train.json")
    assert train.count() < 35  # tickets without an answer are skipped


def test_evaluate_pairs_arrays_by_position_and_compares(spark, tmp_path):
    text = "Type: Incident\nQueue: Sales\nPriority: high\n\nResponse:\n{}"
    references = [{"instruction": "i", "input": f"in {i}", "output": text.format(f"reply {i}")} for i in range(4)]
    predictions = references[:3]
    for name, records in (("refs", references), ("preds", predictions)):
        (tmp_path / f"{name}.json").write_text(json.dumps(records))
    read = [
        readers.read_json_array(spark, str(tmp_path / f"{n}.json"), schemas.INSTRUCTION_SAMPLES) for n in ("preds", "refs")
    ]
    out = str(tmp_path / "eval" / "m-lora-rank32")
    samples = jobs.evaluate(spark, *read, out)
    sheet_schema = "id long, input string, reference string, prediction string"
    sheet_schema = T._parse_datatype_string(sheet_schema + RATINGS)
    assert rows(samples, "sample_id", "rougeL_f") == [(0, 1.0), (1, 1.0), (2, 1.0)]
    sheet = readers.read_csv(spark, f"{out}/review", sheet_schema)
    assert rows(sheet, "id") == [(1,), (2,), (3,)]
    # band and sample files beside the record are not results
    table = jobs.compare(spark, str(tmp_path / "eval"), str(tmp_path / "cmp"))
    assert rows(table, "model", "parameter", "avg_rougeL_f") == [("m-lora-rank32", "Rank=32", 1.0)]
    assert spark.read.json(str(tmp_path / "cmp/targets")).filter("achieved").count() == 3
