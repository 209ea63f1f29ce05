import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import brute
from dialogprep.operators import prepare, template
from dialogprep.plans.corpus import prepare_corpus
from dialogprep.plans.queries import chat_convs, dialogs, doc_convs
from dialogprep.sources import storage, tables
from dialogprep.streaming.prepare import prepare_stream
from dialogprep.streaming.sinks import drain


def lines(path):
    return [json.loads(x) for f in Path(path).rglob("*.json") for x in f.read_text("utf-8").splitlines()]


def test_json_lines(spark, small, tmp_path):
    path = str(tmp_path / "out")
    convs = chat_convs(spark, small)
    tables.write_messages(convs, path, keys=())
    got = lines(path)
    assert all(list(x) == ["messages"] and list(x["messages"][0]) == ["role", "content"] for x in got)
    want = [[(m.role, m.content) for m in r.messages] for r in convs.collect()]
    assert sorted([(m["role"], m["content"]) for m in x["messages"]] for x in got) == sorted(want)
    back = tables.read_messages(spark, path)
    assert back.select("messages").exceptAll(convs.select("messages")).isEmpty()
    assert back.where("conv_id IS NULL OR part <> 0").isEmpty()
    assert template.bos_check(template.render(back)).where("NOT one_bos").isEmpty()


def test_text_is_written_unescaped(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, ["héllo “x”", "\U0001f600 ok"])], "conv_id bigint, dialog array<string>")
    tables.write_messages(prepare.prepare_dialogs(df), path)
    raw = "".join(f.read_text("utf-8") for f in Path(path).glob("*.json"))
    assert "héllo" in raw and "\U0001f600" in raw and "\\u" not in raw


def test_malformed_line_fails(spark, tmp_path):
    bad = tmp_path / "bad.json"
    bad.write_text('{"messages": [}\n')
    with pytest.raises(Exception):
        tables.read_messages(spark, str(bad)).collect()


def test_splits_and_pruning(spark, small, tmp_path):
    path = str(tmp_path / "out")
    df = doc_convs(spark, small).withColumn("split", F.when(F.col("conv_id") % 5 == 0, "val").otherwise("train"))
    tables.write_messages(df, path)
    named = tables.read_splits(spark, {"train": f"{path}/split=train", "validation": f"{path}/split=val"})
    counts = {r["split"]: r["count"] for r in named.groupBy("split").count().collect()}
    assert counts == {"train": df.where("split = 'train'").count(), "validation": df.where("split = 'val'").count()}
    val = tables.read_split_dir(spark, path).where("split = 'val'")
    assert "PartitionFilters: [isnotnull(split" in val._jdf.queryExecution().executedPlan().toString()
    assert val.count() == counts["validation"]


def test_missing_inputs_are_all_named(spark, small):
    with pytest.raises(FileNotFoundError) as e:
        tables.require_inputs(spark, ["/no/a", f"{small}/events.parquet", "/no/b"])
    assert "/no/a" in str(e.value) and "/no/b" in str(e.value) and "events" not in str(e.value)
    tables.require_inputs(spark, [f"{small}/*.parquet"])


@pytest.mark.parametrize("layout", ["turns", "dialogs"])
def test_corpus_job(spark, small, tmp_path, layout):
    source = f"{small}/conversations.parquet"
    if layout == "dialogs":
        source = str(tmp_path / "in")
        dialogs(spark, small).withColumn("act", F.lit(1)).write.parquet(source)
    counts = prepare_corpus(spark, source, str(tmp_path / "out"), layout)
    got = lines(str(tmp_path / "out"))
    assert counts["kept"] == len(got) == counts["train"] + counts["val"]
    assert counts["val"] == max(1, counts["kept"] // 20)
    for x in got:
        texts = [m["content"] for m in x["messages"]]
        assert brute.prepare(texts) == [(m["role"], m["content"]) for m in x["messages"]]


def test_turns_to_dialogs(spark, small):
    turns = spark.read.parquet(f"{small}/conversations.parquet")
    one = {r.conv_id: r.dialog for r in tables.turns_to_dialogs(turns).collect()}
    cfg = prepare.PrepareConfig(part_messages=2, block_rows=2)
    parts = {}
    for r in tables.turns_to_dialogs(turns, cfg).orderBy("conv_id", "part").collect():
        parts.setdefault(r.conv_id, []).extend(r.dialog)
    assert parts == one
    assert set(turns.columns) >= {"role"} and all(isinstance(d, list) for d in one.values())


def test_prepare_stream_equals_batch(spark, small, tmp_path):
    path = str(tmp_path / "in")
    dialogs(spark, small).repartition(3).write.parquet(path)
    stream = spark.readStream.schema("conv_id bigint, dialog array<string>").option("maxFilesPerTrigger", 1).parquet(path)
    got = drain(prepare_stream(stream), "prep")
    batch = doc_convs(spark, small)
    assert got.select("conv_id", "messages").exceptAll(batch.select("conv_id", "messages")).isEmpty()
    assert got.count() == batch.count()
    assert 0 < got.where("split = 'val'").count() < 0.2 * got.count()


def test_shared_folder_comes_from_the_session(spark):
    assert storage.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_spread_leaves_wide_scans_alone(spark, small, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(1000).repartition(16).write.option("parquet.block.size", 1024).parquet(path)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(256 * 1024 * 1024))
    try:
        wide = spark.read.parquet(path)
        assert storage.spread(wide, "id") is wide
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    narrow = spark.read.parquet(f"{small}/documents.parquet")
    assert storage.spread(narrow, "doc_id") is not narrow


def test_command_line(spark, small, tmp_path, capsys):
    from dialogprep.__main__ import main
    from dialogprep.plans.queries import raw_replies, run_losses

    out = str(tmp_path / "corpus")
    main(["prepare", f"{small}/conversations.parquet", out, "--layout", "turns"])
    assert json.loads(capsys.readouterr().out)["kept"] == 5
    main(["inspect", out])
    main(["plan", out])
    run_losses(spark, small).write.parquet(str(tmp_path / "losses"))
    raw_replies(spark, small).withColumn("prompt_id", F.col("conv_id") * 1000 + F.col("i")).write.parquet(str(tmp_path / "raw"))
    main(["evaluate", "--losses", str(tmp_path / "losses"), "--replies", str(tmp_path / "raw"), "--compare", "stopped", "rambling"])
    shown = capsys.readouterr().out
    assert "<bos><start_of_turn>user" in shown and "steps_per_epoch" in shown and "looping_replies" in shown


def test_rows_without_ids_stay_apart(spark, tmp_path):
    bare = spark.createDataFrame([([("user", "hi"), ("model", "yo")],)] * 10, "messages array<struct<role:string,content:string>>")
    bare.write.json(str(tmp_path / "bare"))
    assert tables.read_messages(spark, str(tmp_path / "bare")).select("conv_id").distinct().count() == 10
    spark.createDataFrame([(["hello", "there"],)] * 40, "dialog array<string>").write.parquet(str(tmp_path / "dialogs"))
    assert prepare_corpus(spark, str(tmp_path / "dialogs"), str(tmp_path / "out")) == {"kept": 40, "train": 38, "val": 2}


def test_separator_is_plain_text(spark):
    texts = spark.createDataFrame([(1, "ab|cd")], "id bigint, text string")
    assert tables.dialogs_from_text(texts, "id", "text", "|").first().dialog == ["ab", "cd"]
