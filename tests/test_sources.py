import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from ticketgrain import schemas
from ticketgrain.operators import generation as gen
from ticketgrain.operators.generation import pair_by_position
from ticketgrain.operators import tickets as tk
from ticketgrain.sources import readers, writers
from ticketgrain.sources.positions import with_positions

EDGE = [
    (1, 'He said "no", twice\nand\r\nleft', "high"),
    (2, "None", None),
    (3, None, "low"),
    (4, "  blanks \t kept  ", "a,b"),
    (5, "back\\slash \\n", "q"),
]


def test_csv_keeps_edge_texts(spark, tmp_path):
    data = spark.createDataFrame(EDGE, "id long, text string, priority string")
    path = str(tmp_path / "csv")
    writers.write_csv(data, path)
    assert rows(readers.read_csv(spark, path, data.schema)) == sorted(EDGE, key=repr)
    replaced = readers.read_csv(spark, path, data.schema, na_values=["None"])
    assert {r["id"]: r["text"] for r in replaced.collect()}[2] is None


def test_load_split_reads_csv_or_partition(spark, tmp_path):
    raw = [("s", "b", "a", None, "q", None, "en", *[None] * 8)]
    tickets = tk.with_text(spark.createDataFrame(raw, schemas.RAW_TICKETS))
    base = str(tmp_path / "csv")
    writers.write_csv(tickets.select(*schemas.PROCESSED_TICKETS.names), f"{base}/tickets_train.csv")
    loaded = tk.with_defaults(readers.load_split(spark, base, "train")).first()
    assert (loaded["text"], loaded["priority"], loaded["n_words"]) == ("s\n\nb", "medium", 2)
    with pytest.raises(FileNotFoundError):
        readers.load_split(spark, base, "test")

    parts = str(tmp_path / "parts")
    writers.write_splits(spark.createDataFrame([(1, "train"), (2, "val")], "id long, split string"), parts)
    only = readers.load_split(spark, parts, "val")
    assert rows(only) == [(2, "val")]
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_json_array_and_lines(spark, tmp_path):
    records = [{"instruction": "i", "input": "ü\n", "output": "o"}, {"instruction": "i2", "input": "x"}]
    (tmp_path / "array.json").write_text(json.dumps(records, ensure_ascii=False, indent=2), "utf-8")
    array = readers.read_json_records(spark, str(tmp_path / "array.json"), schemas.INSTRUCTION_SAMPLES, array=True)
    assert rows(array) == [("i", "ü\n", "o"), ("i2", "x", None)]
    path = str(tmp_path / "lines")
    writers.write_samples(array, path)
    assert rows(readers.read_json_records(spark, path, schemas.INSTRUCTION_SAMPLES)) == rows(array)


def test_evaluation_files(spark, tmp_path):
    metrics = {"avg_rougeL_f": 0.4555, "priority_accuracy": 0.571}
    for name, content in {
        "m-lora rank128+x": {"aggregated": metrics, "sample_count": 4240},
        "base": {"aggregated": {"type_accuracy": 0.4991}, "sample_count": 4240},
    }.items():
        (tmp_path / "eval" / name).mkdir(parents=True)
        (tmp_path / "eval" / name / "evaluation_results.json").write_text(json.dumps(content, indent=2))
    found = readers.load_evaluations(spark, str(tmp_path / "eval"))
    assert rows(found, "model", "avg_rougeL_f", "type_accuracy") == [
        ("base", None, 0.4991), ("m-lora rank128+x", 0.4555, None),
    ]
    (tmp_path / "flat.json").write_text(json.dumps(metrics))
    flat = readers.load_results(spark, str(tmp_path / "flat.json")).first()
    nested = readers.load_results(spark, str(tmp_path / "eval/base/evaluation_results.json")).first()
    assert (flat["priority_accuracy"], nested["type_accuracy"]) == (0.571, 0.4991)


def test_written_evaluation_is_read_back(spark, tmp_path):
    pairs = spark.createDataFrame([(1, "a b", "a c")], "sample_id long, prediction string, reference string")
    total = gen.aggregate_samples(gen.evaluate_samples(pairs, ["sample_id"], "response_generation"))
    path = str(tmp_path / "eval" / "m1" / "evaluation_results.json")
    writers.write_evaluation(total, path)
    row = readers.load_evaluations(spark, str(tmp_path / "eval")).first()
    assert (row["model"], row["avg_rouge1_f"], row["avg_pred_length"]) == ("m1", 0.5, 2.0)
    assert readers.load_results(spark, path).first()["avg_rouge1_f"] == 0.5


def test_manifest(spark):
    first = writers.merge_manifest(None, writers.manifest_entries(spark, "multi_task"))
    assert ("ticket_multi_task_val", "alpaca_multi_task_val.json", "alpaca") in rows(first)
    old = spark.createDataFrame([("ticket_multi_task_val", "old.json", "x"), ("mine", "m.json", "y")], schemas.MANIFEST)
    merged = {r["name"]: r["file_name"] for r in writers.merge_manifest(old, first).collect()}
    assert merged["mine"] == "m.json" and merged["ticket_multi_task_val"] == "alpaca_multi_task_val.json"
    assert len(merged) == 4


def test_experiment_files(spark, tmp_path):
    config = ("E1", "distil", 2e-5, 1, False, 32, "d")
    runs = spark.createDataFrame([(config, [(1, 0.5, 0.6, 0.6, 0.7, 0.65, 0.7)], 0.65)], schemas.EXPERIMENTS)
    summary = spark.createDataFrame([("E1", 0.65)], "name string, best_val_f1 double")
    writers.write_experiments(runs, summary, str(tmp_path / "exp"))
    back = readers.read_json_records(spark, str(tmp_path / "exp/experiments"), schemas.EXPERIMENTS)
    from ticketgrain.operators.experiments import explode_epochs

    assert rows(explode_epochs(back), "exp", "epoch", "val_f1_macro") == [("E1", 1, 0.65)]


def test_instruction_samples_rules(spark):
    raw = [
        ("Hi", "body", "ans", "Incident", "Sales", "high", "en", "t1", None, "", *[None] * 5),
        (None, "only body", None, None, None, None, None, *[None] * 8),
        ("only subject", None, "ans", "Change", None, "low", "de", *[None] * 8),
    ]
    data = spark.createDataFrame(raw, schemas.RAW_TICKETS)
    assert tk.filter_language(data).count() == 1
    assert tk.filter_language(data.drop("language")).count() == 3
    multi = [r["output"] for r in tk.instruction_samples(data).collect()]
    assert multi[0] == "Classification:\n- Type: Incident\n- Queue: Sales\n- Priority: high\n- Tags: t1\n\nResponse:\nans"
    assert multi[1] == "Classification:\n- Type: Unknown\n- Queue: Unknown\n- Priority: medium\n- Tags: None\n\nResponse:\n"
    one_line = tk.instruction_samples(data, "classification").collect()[2]
    assert one_line["output"] == "Type: Change | Queue: Unknown | Priority: low"
    assert one_line["input"] == "Subject: only subject\n\nContent:\n"
    answers = tk.instruction_samples(data, "response_generation")
    assert tuple(tk.sample_counts(answers).first()) == (2, 1)
    assert tk.valid_samples(answers).count() == 2
    with pytest.raises(ValueError, match="unknown task"):
        tk.instruction_samples(data, "other")
    with pytest.raises(ValueError, match="missing columns"):
        tk.with_text(data.drop("body"))


def test_predictions_keep_reference(spark, tmp_path):
    data = spark.createDataFrame([(1, "i", "x", "out", "ref")], schemas.PREDICTIONS)
    writers.write_predictions(data, str(tmp_path / "p"))
    back = readers.read_json_records(spark, str(tmp_path / "p"), schemas.PREDICTIONS)
    assert rows(back) == [(1, "i", "x", "out", "ref")]
    writers.write_review(back.select(F.col("sample_id").alias("id"), "input"), str(tmp_path / "r"))


def test_positions_over_files_and_splits(spark, tmp_path):
    """Places follow file names and lines, whatever task reads which split of which file."""
    path = tmp_path / "lines"
    path.mkdir()
    wanted = []
    for name, n in (("part-2", 700), ("part-0", 1), ("part-10", 300), ("part-1", 0)):
        (path / name).write_text("".join(f'{{"a": "{name}-{i}"}}\n' for i in range(n)))
    for name in sorted(p.name for p in path.iterdir()):
        wanted += [row.split('"')[3] for row in (path / name).read_text().splitlines()]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1k", "3k", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = with_positions(spark.read.schema("a string").json(str(path)))
            assert [r.a for r in found.orderBy("position").collect()] == wanted
            assert sorted(r.position for r in found.collect()) == list(range(1001))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert with_positions(spark.read.schema("a string").json(str(path / "part-1"))).count() == 0


def test_json_arrays(spark, tmp_path):
    """Pretty-printed and written arrays, an empty one among them; places go on over the files."""
    (tmp_path / "in").mkdir()
    data = [{"a": "x\n[1]", "b": 1}, {"a": None, "b": 2}, {"b": 3}, {"a": "é, ]", "b": None}]
    (tmp_path / "in" / "1.json").write_text(json.dumps(data[:3], indent=2))
    (tmp_path / "in" / "2.json").write_text("[]")
    (tmp_path / "in" / "3.json").write_text(json.dumps(data[3:]))
    read = lambda p: [tuple(r) for r in readers.read_json_array(spark, str(p), "a string, b long").orderBy("sample_id").collect()]
    wanted = [(i, d.get("a"), d["b"]) for i, d in enumerate(data)]
    assert read(tmp_path / "in") == wanted
    rows_of = spark.createDataFrame([(d.get("a"), d["b"]) for d in data], "a string, b long")
    writers.write_json_arrays(rows_of.coalesce(1), str(tmp_path / "one"))
    writers.write_json_arrays(rows_of.repartition(7), str(tmp_path / "many"))
    assert read(tmp_path / "one") == wanted and sorted(read(tmp_path / "many"))[-1][0] == 3
    for file in (tmp_path / "many").glob("part-*"):
        assert all(set(r) == {"a", "b"} for r in json.loads(file.read_text()))


def test_pairs_by_position(spark, tmp_path):
    """As a zip of two lists: the shorter side decides."""
    for name, n in (("p", 25), ("r", 40)):
        (tmp_path / name).mkdir()
        for file in range(3):
            (tmp_path / name / f"part-{file}").write_text("".join(f'{{"{name}": "{name}{i}"}}\n' for i in range(n) if i * 3 // n == file))
    sides = [with_positions(spark.read.schema(f"{name} string").json(str(tmp_path / name)), "sample_id") for name in ("p", "r")]
    assert [(r.p, r.r) for r in pair_by_position(*sides).orderBy("sample_id").collect()] == [(f"p{i}", f"r{i}") for i in range(25)]
