from pyspark.sql import functions as F

import brute
from dialogprep.config import ChatTemplate
from dialogprep.functions import template as FT
from dialogprep.operators import prepare, template
from dialogprep.plans.queries import chat_convs, doc_convs

SCHEMA = "conv_id bigint, part int, messages array<struct<role:string,content:string>>"


def one(spark, messages, part=0):
    return spark.createDataFrame([(1, part, messages)], SCHEMA)


def test_golden(spark):
    df = one(spark, [("user", "Hi"), ("model", " Yo　\n")])
    text = "<bos><start_of_turn>user\nHi<end_of_turn>\n<start_of_turn>model\nYo<end_of_turn>\n"
    assert template.render(df).first().text == text
    assert template.render(df, True).first().text == text + "<start_of_turn>model\n"
    assert template.labeled_text(df).first().labeled == "Yo<end_of_turn>"
    pair = template.context_reply_pairs(df).first()
    assert pair.prompt == "<bos><start_of_turn>user\nHi<end_of_turn>\n<start_of_turn>model\n"
    assert pair.completion == "Yo<end_of_turn>"


def test_assistant_counts_as_reply(spark):
    df = one(spark, [("user", "a b"), ("assistant", "c"), ("user", "d"), ("model", "e")])
    assert [r.labeled for r in template.labeled_text(df).collect()] == ["c<end_of_turn>", "e<end_of_turn>"]


def test_other_delimiters(spark):
    tpl = ChatTemplate(bos="<s>", turn_open="[", turn_close="]", reply_role="bot", reply_roles=("bot",))
    df = one(spark, [("user", "x"), ("bot", "y")])
    assert template.render(df, True, tpl).first().text == "<s>[user\nx]\n[bot\ny]\n[bot\n"
    assert template.labeled_text(df, tpl).first().labeled == "y]"


def test_corpus(spark, small):
    for convs in (chat_convs(spark, small), doc_convs(spark, small)):
        rows = {r.conv_id: [(m.role, m.content) for m in r.messages] for r in convs.collect()}
        texts = {r.conv_id: r.text for r in template.render(convs).collect()}
        assert texts == {c: brute.render(m) for c, m in rows.items()}
        assert template.bos_check(template.render(convs)).where("NOT one_bos").isEmpty()
        for s in template.span_rows(convs).collect():
            content = rows[s.conv_id][2 * s.reply + 1][1]
            assert texts[s.conv_id][s.start : s.end] == content + "<end_of_turn>"
        for p in template.context_reply_pairs(convs).collect():
            history = rows[p.conv_id][: 2 * p.reply + 1]
            assert p.prompt == brute.render(history, opener=True)
        labeled = {r.conv_id: r for r in template.label_fraction(convs).collect()}
        for conv, messages in rows.items():
            want = sum(len(t) + len("<end_of_turn>") for r, t in messages if r == "model")
            assert labeled[conv].labeled_chars == want
            assert labeled[conv].total_chars == len(texts[conv])


def test_parts_join_to_the_whole_text(spark):
    messages = [("user" if i % 2 == 0 else "model", f"turn {i}") for i in range(10)]
    dialog = spark.createDataFrame([(1, [t for _, t in messages])], "conv_id bigint, dialog array<string>")
    parts = prepare.prepare_dialogs(dialog, prepare.PrepareConfig(part_messages=4))
    texts = [r.text for r in template.render(parts).orderBy("part").collect()]
    assert len(texts) == 3 and "".join(texts) == brute.render(messages)
    for s in template.span_rows(parts).collect():
        assert texts[s.part][s.start : s.end] == f"turn {4 * s.part + 2 * s.reply + 1}<end_of_turn>"


def test_bos(spark):
    df = spark.createDataFrame([("<bos>a",), ("<bos><bos>a",), ("a<bos>",), ("",), (None,)], "text string")
    assert [r.one_bos for r in template.bos_check(df).collect()] == [True, False, False, False, False]
    ids = spark.createDataFrame([([2, 5],), ([2, 2],), ([5, 2],), ([2],)], "ids array<int>")
    checked = ids.select(FT.ids_start_with_one_bos(F.col("ids"), 2).alias("ok")).collect()
    assert [r.ok for r in checked] == [True, False, False, True]


def test_token_mask(spark):
    """Tokens across a border count; those without characters, or before any reply, do not."""
    messages = [("user", "Hi"), ("model", "Yo"), ("user", "a"), ("assistant", "b \U0001f642")]
    text = brute.render(messages)
    cuts = [0, 0, 5, text.index("Yo") - 1, text.index("Yo") + 1, text.index("Yo") + 17, text.index("Yo") + 18, len(text)]
    offsets = list(zip(cuts, cuts[1:]))
    tokens = one(spark, messages).select(
        "*", F.expr(f"array({','.join(str(10 + i) for i in range(len(offsets)))})").alias("ids"),
        F.from_json(F.lit(str([{"start": a, "end": b} for a, b in offsets]).replace("'", '"')), "array<struct<start:bigint,end:bigint>>").alias("offsets"),
    )
    spans = template.span_rows(one(spark, messages)).collect()
    want = [int(a < b and any(s.start < b and a < s.end for s in spans)) for a, b in offsets]
    got = template.token_mask(tokens).first()
    assert got.assistant_masks == want == [0, 0, 0, 1, 1, 0, 1]
    assert got.labeled_ids == [10 + i for i, m in enumerate(want) if m]
    assert template.token_mask(tokens, replies_only=False).first().assistant_masks == [1] * len(want)


def test_token_bos(spark):
    ids = spark.createDataFrame([([2, 5],), ([2, 2],), ([5, 2],), ([2],), ([],), (None,)], "ids array<int>")
    assert [r.one_bos for r in template.token_bos_check(ids, 2).collect()] == [True, False, False, True, False, False]


def test_whole_sequences(spark):
    df = one(spark, [("user", "Hi"), ("model", "Yo")])
    row = template.label_fraction(df, replies_only=False).first()
    assert row.labeled_chars == row.total_chars == len(template.render(df).first().text) and row.fraction == 1.0


def test_text_is_rendered_once(spark):
    """One regex for the text and one for the spans."""
    df = one(spark, [("user", "Hi"), ("model", "Yo")])
    plan = template.context_reply_pairs(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 2
