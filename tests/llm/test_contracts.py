"""Queries against plain versions, and edge cases of every operator."""

from __future__ import annotations

import gc
import random

import brute_llm as plain
import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dialogprep.llm import bpe, common, fingerprints, grammar, langid, lines, neighbours, packing, pii, simhash, tokens, toxicity
from dialogprep.llm.oracle import ORACLES
from dialogprep.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h long, n long, lost string"
SHARED = "This line stands in many documents, word for word."


def tricky_rows():
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma", "delta.", "épée", "x@y.zz", "10.0.0.1", "+49 (30) 1234-5678", "4111 1111 1111 1111", "\U0001f642", "<|endoftext|>", "1d10t"]
    texts = [None, "", " ", "\n\n", "a", "a" * 3000, "one two", " \t lead", "tail \n", "\x00 zero", " 　odd spaces  twice"]
    for _ in range(25):
        texts.append(" ".join(rng.choices(words, k=rng.randrange(1, 60))) + "\n" + SHARED)
    texts += [texts[15]] * 3 + [texts[15] + " more"]
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s", None, "t"]), None, 1, 2, "x") for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="module")
def tricky(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tricky"))
    spark.createDataFrame(tricky_rows(), DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(40)] + [(1, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    vectors = [(0, [1.0, 0.0], 1), (1, [2.0, 0.01], 1), (2, [1.0, 0.0], 2), (3, None, 1), (4, [0.0, 0.0], 1), (5, [float("nan"), 1.0], 1), (6, [1.0, None], 1), (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [-1.0, 0.0], 1), (10, [], 1), (11, [1e-300, 0.0], 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def sql(folder, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        path = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path if folder.startswith('/root') else path + '/*.parquet'}'")
    return con.sql(ORACLES[name]).df()


def same(got, want):
    columns = sorted(want.columns)
    rows = lambda df: sorted(map(repr, df[columns].astype(str).itertuples(index=False, name=None)))
    return rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_tricky_rows(spark, tricky, name):
    got = QUERIES[name](spark, tricky).toPandas()
    docs = [(r[0], r[1]) for r in tricky_rows()]
    if name in ORACLES:
        assert same(got, sql(tricky, name))
    elif hasattr(plain, name):
        assert getattr(plain, name)(got, docs) == "equal"
    else:
        assert sorted(got.doc_id) == [d for d, _ in docs] and got.score.between(0, 1).all()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op5_language", "op6_toxicity"}))
def test_query_on_a_given_table(spark, small, name):
    got = QUERIES[name](spark, small).toPandas()
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    want = same(got, sql(small, name)) if name in ORACLES else getattr(plain, name)(got, docs) == "equal"
    assert want


def test_empty_tables(spark, empty, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frames = [
        lines.drop_repeated_lines(empty),
        bpe.round_trip(empty, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN),
        fingerprints.compare_with_edit(empty),
        fingerprints.fingerprint_documents(empty),
        simhash.near_duplicate_groups(empty),
        simhash.drop_near_duplicates(empty),
        langid.identify(empty),
        toxicity.score_documents(empty, toxicity.learn(empty, labels)),
        pii.personal_data(empty),
        pii.sanitise(empty),
        packing.pack(empty, path),
        neighbours.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)
    grammar.write_documents(empty, path, str(tmp_path / "files"), 2)
    assert grammar.read_documents(spark, str(tmp_path / "files")).count() == 0


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d"), (None, None), (3, "a b c d"), (3, "a b c d"), (3, "other words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert lines.drop_repeated_lines(docs).count() == 5
    assert fingerprints.compare_with_edit(docs).count() == 5
    groups = simhash.near_duplicate_groups(docs).collect()
    assert len(groups) == 5 and {r.component_id for r in groups if r.doc_id == 3} == {3}
    assert simhash.drop_near_duplicates(docs).count() == 5
    assert pii.personal_data(docs).count() == 5 and pii.sanitise(docs).count() == 5
    assert packing.pack(docs, path).agg(F.sum("length")).first()[0] == 5 + 4 * 3 + 3


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(0, i) for i in range(900, 950)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    root = plain.groups(1000, pairs)
    assert got == {n: root[n] for n in {x for a, b in pairs if a != b for x in (a, b)}}


@pytest.mark.parametrize("dense", [8192, 3])
def test_simhash_groups_with_full_keys(spark, dense):
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join([*base[: i % 7], "new", *base[i % 7 :], str(i % 30)])) for i in range(60)] + [(100, "nothing alike"), (101, None), (102, "")]
    got = simhash.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string"), dense=dense).toPandas()
    got["fingerprint"] = [f"{int(p) & (1 << 64) - 1:016x}" for p in got["print"]]
    assert plain.op4_simhash(got, rows) == "equal"


def test_keys_meet_for_all_three_bit_errors():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in x], dtype=np.uint64)
    sets = []
    for prints in (x, x ^ flips):
        row, key, home = simhash.keys(prints)
        every, own = [set() for _ in x], [set() for _ in x]
        for r, k, h in zip(row, key, home, strict=True):
            every[r].add(k)
            if h:
                own[r].add(k)
        sets.append((every, own))
    assert all(sets[0][1][i] & sets[1][0][i] and sets[1][1][i] & sets[0][0][i] for i in range(len(x)))


def test_a_full_key_is_told_though_its_home_member_comes_last():
    columns = [pa.array([7] * 10), pa.array(range(10)), simhash._binary(np.arange(10, dtype=np.uint64)[:, None]), pa.array([False] * 9 + [True])]
    batch = pa.RecordBatch.from_arrays(columns, ["key", "node", "print", "home"])
    told = [simhash._links(*own, simhash.MAX_BITS, 3) for own in simhash._whole_keys(iter([batch]), 3)]
    assert [(a.to_pylist(), b.to_pylist()) for a, b in told] == [([7], [None])]


@pytest.mark.parametrize("stage", [False, True])
def test_one_document_of_each_simhash_group_stays(spark, stage, tmp_path):
    """Which documents go is what brute force over all pairs of fingerprints says, copies with one word changed among them."""
    rng = random.Random(4)
    rows = []
    for i in range(60):
        words = [f"{rng.randrange(10**6)}" for _ in range(400)]
        rows += [(i, " ".join(words)), (200 + i, " ".join(words))]
        words[rng.randrange(400)] = "new"
        rows.append((100 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(corpus_pipeline.STAGES)["simhash"](spark, docs, str(tmp_path)) if stage else simhash.drop_near_duplicates(docs)
    rows = sorted(rows)
    prints = [plain.simhash(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = plain.groups(len(rows), links)
    kept = {rows[r][0] for r in root}
    assert {r.doc_id for r in got.collect()} == kept and set(range(60)) <= kept < set(range(160))


def test_fingerprints_add_up_in_any_order():
    one, two, both, turned = (f.tobytes().hex() for f in fingerprints.fingerprint(["a b c d", "e f", "a b c d\ne f", "e f\na b c d"]))
    assert both == turned == fingerprints.added(one, two) and fingerprints.removed(both, two) == one


@pytest.mark.parametrize("copies", [100, 200, 256, 300])
def test_likeness_of_a_line_that_stands_often(copies):
    line = "one two three four five six"
    text = "\n".join([line] * copies)
    edited = "\n".join([line] * (copies // 2))
    own, half, both = fingerprints.fingerprint([text, edited, text + "\n" + edited])
    assert fingerprints.likeness(own[None], half[None])[0] == pytest.approx(0.8)
    assert both.tobytes().hex() == fingerprints.added(own.tobytes().hex(), half.tobytes().hex())
    assert own.tobytes().hex() == fingerprints.removed(both.tobytes().hex(), half.tobytes().hex())


def test_likeness_of_millions_of_words():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 50, 3_000_000).astype(str).tolist()
    text, half = " ".join(words), " ".join(words[: len(words) // 2])
    _, hashes = fingerprints.shingles([text])
    _, fewer = fingerprints.shingles([half])

    def sums(h):
        sign = 1 - 2 * ((h >> np.uint64(32)) & np.uint64(1)).astype(np.int64)
        return np.bincount((h & np.uint64(255)).astype(np.int64), weights=sign, minlength=256)

    x, y = sums(hashes), sums(fewer)
    want = 1 - np.square(x - y).sum() / (np.square(x).sum() + np.square(y).sum())
    own, other = fingerprints.fingerprint([text, half])
    assert fingerprints.likeness(own[None], other[None])[0] == pytest.approx(want)


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(0)
    for ids in (np.zeros(999, int), np.arange(7), rng.integers(0, 5, 5000), np.array([9])):
        last = np.unique(np.append(rng.integers(0, len(ids), 3), len(ids) - 1))
        g, coded, ends = grammar.compress(ids, last)
        assert (g.decode(coded) == ids).all() and len(coded) <= len(ids)
        assert [g.decode(coded[:e]).size for e in ends] == (last + 1).tolist()
        assert all(g.at(coded, p) == ids[p] for p in range(0, len(ids), 97))


def test_packing_keeps_to_shares(spark):
    rows = [(i, "word " * 200, "a" if i % 4 else "b") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), bucket_tokens=20_000).toPandas()
    whole = got.groupby("sequence_id").filter(lambda g: g["length"].sum() == 1024)
    share = whole[whole.source == "b"].groupby("sequence_id")["length"].sum().reindex(whole.sequence_id.unique(), fill_value=0) / 1024
    assert abs(share.mean() - 0.25) < 0.05 and (abs(share - 0.25) <= 0.26).mean() > 0.9


def test_pii_terms_and_masks(spark):
    rows = [(i, f"filler number{i} words. Contact Zanzibarius at jo@ex.org today") for i in range(5)] + [(10 + i, f"plain text {i} of today at noon") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert all("term:" in found[i] and "email:" in found[i] for i in range(5)) and all(found[10 + i] == "" for i in range(30))
    text = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "<email>" in text[0] and "Zanzibarius" not in text[0] and text[10] == rows[5][1]


def test_pii_terms_of_the_whole_document_go_everywhere(spark):
    rows = [(i, f"Zanzibarius Quux\n+1 555 010 9999{' and then some more' * 40}. The boat Marigoldy lies here") for i in range(5)]
    rows += [(10, "A letter of Zanzibarius, without a number; Zanzibarius again")] + [(20 + i, f"plain text {i} and then some more. The boat lies here") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    text = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert not any(name in t for t in text.values() for name in ("Zanzibarius", "Quux", "Marigoldy", "555"))
    assert text[0].startswith("<term> <term>\n<phone> and then some more") and text[0].endswith("The boat <term> lies here")
    assert text[10] == "A letter of <term>, without a number; <term> again" and all(text[i] == t for i, t in rows if i >= 20)


def test_toxic_words_are_restored_and_scored(spark):
    rng = random.Random(2)
    words = ["hello", "good", "stone", "water", "light", "number", "people", "morning"]
    rows = [(i, " ".join(rng.choices(words, k=30)) + (" idiot moron" if i % 5 == 0 else "")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    scorer = toxicity.learn(docs, labels)
    assert scorer.restore("you 1d10t, m o r o n") == "you idiot, moron"
    for hidden in ("iddioott", "i - d - i - o - t", "i/d/i/o/t", "i  d  i  o  t", "\"1diot", "1d10t", "i\nd\ni\no\nt", "idiiiot"):
        assert "idiot" in scorer.words(f"you {hidden} there"), hidden
    for hidden in ("id iot", "id-iot", "idi ot,", "mo ron"):
        assert {"idiot", "moron"} & scorer.words(f"such an {hidden} there"), hidden
    assert {"idiot", "moron"}.isdisjoint(scorer.words("an id for the iot and more on 5 letters committee address b12 2024 great!"))
    new = spark.createDataFrame([(1, "what an 1d10t m.o.r.o.n good stone"), (2, "good morning people"), (3, None), (4, "x" * 50000)], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in toxicity.score_documents(new, scorer).collect()} == {1: 1, 2: 0, 3: 0, 4: 0}


def test_held_out_languages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.95
    none = langid.predict(spark.createDataFrame([(1, None), (2, "123 ."), (3, "the and")], "doc_id long, text string"), langid.learn(docs))
    assert [r.lang_pred for r in none.orderBy("doc_id").collect()] == ["und", "und", "en"]


@pytest.mark.parametrize("block", [2048, 7])
def test_vectors_in_many_cells(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "CELL_VECTORS", 20)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 16))
    x[100:200] = x[:100] + 0.1 * rng.normal(size=(100, 16))
    x[200:240] = x[0] + 0.05 * rng.normal(size=(40, 16))
    label = rng.integers(0, 2, 300)
    label[100:200], label[200:240] = label[:100], label[0]
    rows = [(i, [float(v) for v in r], int(k)) for i, (r, k) in enumerate(zip(x, label, strict=True))]
    got = neighbours.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), block=block).toPandas().sort_values("vec_id")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = (u @ u.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    assert got.n_links.sum() >= 0.9 * near.sum() and (got.n_links.to_numpy() <= near.sum(axis=1)).all()


def test_pipeline_stages(spark, tricky):
    docs = common.table(spark, tricky, "documents")
    columns, before = docs.columns, docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, tricky)
        docs = docs.cache()
        assert docs.columns == columns and docs.count() <= before, name
        before = docs.count()
    kept = [line for r in docs.collect() for line in (r.text or "").split("\n")]
    assert not any("x@y.zz" in line for line in kept)
    assert kept.count(SHARED) == 1
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, tricky)
    assert pieces.select("doc_id").distinct().count() == before


def lines_left(rows, min_docs=5):
    """(doc_id, text) after line dedup, by brute force."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    held = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                held.setdefault(key(line), set()).add(doc_id)
    keeper = {k: max(own, key=lambda d: -1 if d is None else d) for k, own in held.items() if len(own) >= min_docs}
    return sorted((repr(d), "\n".join(x for x in (t or "").split("\n") if keeper.get(key(x), d) == d)) for d, t in rows)


@pytest.mark.parametrize("sent", [64 << 20, 0])
def test_lines_by_filters_that_travel_or_stay(spark, monkeypatch, sent):
    monkeypatch.setattr(lines, "SENT_BYTES", sent)
    monkeypatch.setattr(lines.suspected, "__defaults__", (sent,))
    rng = random.Random(2)
    pool = [f"line {i} that is long enough to be looked at by the filters" for i in range(400)]
    rows = [(i, "\n".join([*rng.choices(pool, k=rng.randrange(6)), pool[0] if i % 3 else "short", f"own line of document {i}, which nothing repeats"])) for i in range(300)]
    rows += [(None, pool[0] + "\n" + pool[1]), (None, pool[1]), (7, pool[0]), (7, pool[0]), (500, "\t" + pool[0].upper() + " "), (501, None), (502, "")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_lines int").repartition(3)
    got = lines.drop_repeated_lines(docs)
    assert sorted((repr(r.doc_id), r.text) for r in got.collect()) == lines_left(rows)


def test_lines_of_a_very_long_text(spark):
    """Megabytes in one document, and a line that a third of all rows share."""
    common = "a line that very many documents have in common, as it is"
    rows = [(0, "\n".join(f"line number {i} of a very long document, not repeated" for i in range(60_000)) + "\n" + common)]
    rows += [(i, common if i % 3 == 0 else f"a document of its own, that is number {i} of all") for i in range(1, 900)]
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == (60_001, 1) and sum(n for _, n in got.values()) == 299 and got[897] == (1, 0)


def test_only_hashes_and_suspected_lines_are_shuffled(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    lines_of = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("key")).select("doc_id", "key", F.xxhash64("key").alias("h"))
    plan = lines.suspected(lines_of)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_a_filter_grows_and_forgets_nothing():
    rng = np.random.default_rng(0)
    held, others = rng.integers(-(1 << 63), 1 << 63, (2, 60_000))
    one = lines.Filter()
    for part in np.array_split(held, 17):
        one.add(part)
    again = lines.Filter.of([level.words.tobytes() for level in one.levels])
    assert len(one.levels) > 3 and one.has(held).all() and again.has(held).all() and again.has(others).mean() < 0.05


def test_pii_counts_repeated_rows_once(spark):
    rng = random.Random(1)
    rows = [(i, f"filler number{i} words {rng.randrange(10**6)} {rng.randrange(10**6)}") for i in range(60)]
    rows += [(100 + i, f"some text {rng.randrange(10**6)} Zanzibarius wrote to z@mail.org there") for i in range(4)]
    once = spark.createDataFrame(rows, "doc_id long, text string")
    masked = lambda docs: {(r.doc_id, r.text) for r in pii.sanitise(docs).collect()}
    want = masked(once)
    assert sum("<term>" in t for _, t in want) >= 4 and not any("Zanzibarius" in t for _, t in want)
    twice = once.unionByName(once)
    assert masked(twice) == want and pii.sanitise(twice).count() == 128
    third = once.unionByName(spark.createDataFrame(rows[-1:] * 60, "doc_id long, text string"))
    assert masked(third) == want and pii.personal_data(third).count() == 124


def test_pii_of_a_directory_page(spark):
    """Three pages of the same thousand addresses, and addresses of their own documents: dealt to several tasks."""
    page = " ".join(f"name{i} person{i}@mail{i % 50}.org" for i in range(1000))
    rows = [(i, page + f" page {i}") for i in range(3)] + [(10 + i, f"note {i} about nothing") for i in range(60)]
    rows += [(100 + 4 * i + k, f"writer{i} sends {k} from person{i}@mail{i % 50}.org") for i in range(300) for k in range(3)]
    got = {r.doc_id: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("@" not in r.text for r in got.values())
    assert "name5" not in got[0].text and all("writer7" not in got[128 + k].text for k in range(3)) and got[12].text == rows[5][1]


def test_repeated_vectors_count_once(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (3, [1.0, 0.01], 1), (None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    got = neighbours.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    told = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None}
    assert len(got) == 5 and told == {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False)}


def test_ids_of_texts_with_added_tokens():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, library = grammar.word_tokenizer(path), plain.english()
    rng = random.Random(9)
    parts = [" ", "\n", "a", "é", "12", "'s", ".", "<|endoftext|>", "\t", "　", "word", "$$", "ÿ", "\x00", "<|end", "of", "text|>"]
    many = ["", "<|endoftext|>", "foo <|endoftext|> bar", "<|endoftext|><|endoftext|>"] + ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(2000)]
    want = [library.encode(t, add_special_tokens=False).ids for t in many]
    assert [np.frombuffer(raw, own.dtype).tolist() for raw in own.encode_all(many)] == want


def test_grammar_goes_on_until_no_pair_pays(spark, tmp_path):
    """No pair of different symbols is left at LEAST places, and the files are smaller than plain ids."""
    rng = np.random.default_rng(5)
    phrases = [rng.integers(0, 50_000, rng.integers(3, 30)) for _ in range(60)]
    ids = np.concatenate([phrases[i] for i in rng.integers(0, 60, 4000)] + [np.full(1000, 9)])
    last = np.unique(np.append(rng.integers(0, len(ids), 50), len(ids) - 1))
    g, coded, ends = grammar.compress(ids, last, 50_257)
    assert (g.decode(coded) == ids).all() and g.lengths.max() > 8
    inside = np.ones(len(coded), dtype=bool)
    inside[ends - 1] = False
    pairs, n = np.unique(np.stack([coded[:-1], coded[1:]])[:, inside[:-1]], axis=1, return_counts=True)
    assert n[pairs[0] != pairs[1]].max() < grammar.LEAST
    planes = [*grammar._planes(g.rules.ravel()), *grammar._planes(g.lengths), *grammar._planes(coded)]
    assert sum(map(len, planes)) < len(ids)  # two bytes an id are plain
    big = np.array([5, 1 << 16, (1 << 20) + 3, 70_000], dtype=np.int64)
    assert (grammar._numbers(*grammar._planes(big)) == big).all()


def test_files_with_null_and_repeated_ids_and_a_long_text(spark, tmp_path):
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "files")
    rows = [(None, "first"), (None, None), (3, "same words"), (3, "same words"), (4, "a longer text of words and words " * 40_000), (5, "<|endoftext|>")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, shard int, block string")
    grammar.write_documents(docs, path, folder, 2, block_ids=10_000)
    library = plain.english()
    want = sorted((repr(d), [*library.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in rows)
    got = grammar.read_documents(spark, folder).collect()
    assert sorted((repr(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want


def test_pipeline_stages_on_empty_and_repeated_rows(spark, tricky, empty):
    docs = common.table(spark, tricky, "documents")
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, empty, tricky).count() == 0, name
    twice = docs.unionByName(docs)
    for name, function in corpus_pipeline.STAGES[:-1]:
        once = {tuple(r) for r in function(spark, docs, tricky).collect()}
        assert {tuple(r) for r in function(spark, twice, tricky).collect()} == once, name


def test_code_lengths_equal_a_plain_version(spark):
    rows = [("the water and the stone", "en"), ("a number of people", "en"), ("die Zahl der Leute", "de"), ("das Wasser über dem Stein", "de"), ("", "fr"), ("l'eau et la pierre", "fr"), (None, "fr"), ("no language", None)]
    known = [(t or "", lang) for t, lang in rows if lang and t is not None]
    trees = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    many = ["the stone", "über Wasser", "l'eau é", "zzz 99 ñ", "a"]
    got = trees.code_lengths(many)
    for text, own in zip(many, got, strict=True):
        want = plain.language_bits(known, text)
        assert trees.languages == sorted(want) and np.allclose(own, [want[x] for x in trees.languages], rtol=1e-5)
    docs = spark.createDataFrame(list(enumerate(many)), "doc_id long, text string")
    told = {r.doc_id: r.lang_pred for r in langid.predict(docs, trees).collect()}
    assert told == {i: min(sorted(want), key=want.get) for i, want in enumerate(plain.language_bits(known, t) for t in many)}


def test_readings_are_the_cheapest_of_all():
    rng = random.Random(3)
    noise = np.random.default_rng(3)
    model = toxicity.CharacterModel(noise.uniform(0.2, 5, (toxicity.SIZE,) * 3))

    def options(char):
        if char.isalpha():
            return [(char, 0.0)]
        cost = toxicity.HIDDEN_COST if char == "*" else toxicity.SIGN_COST
        return [(x, cost) for x in toxicity.LEET.get(char, "")] or ([] if char in toxicity.BETWEEN else [(char, 0.0)])

    symbol = lambda x: toxicity.SYMBOL.get(x, toxicity.OTHER if x.isalpha() else 0)
    skips = lambda c: toxicity.SEPARATOR_COST if c in toxicity.BETWEEN else None
    for _ in range(300):
        token = "".join(rng.choices("aabst1053@$*!|.- _/x", k=rng.randrange(1, 8)))
        want = plain.cheapest_reading(model.cost, symbol, options, skips, toxicity.REPEAT_COST, token)
        assert abs(model.read(token)[1] - want) < 1e-6


def test_signs_at_a_words_end_are_read_where_that_is_likelier(spark):
    rng = random.Random(8)
    words = ["ass", "asset", "grass", "mass", "water", "boss", "as", "has", "class", "glass"]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=40))) for i in range(200)], "doc_id long, text string")
    scorer = toxicity.Scorer(toxicity.learn_characters(docs))
    assert scorer.restore("what an a55 and a$$ of 5 or 55") == "what an ass and ass of 5 or 55"
    assert scorer.restore("great! wow* 2024 glass7") == "great! wow* 2024 glass7"


def test_long_texts_are_whole(spark):
    """A text of some megabytes through the operators that cut texts into batches."""
    text = " ".join(f"word{i % 5000} and more" for i in range(150_000))
    docs = spark.createDataFrame([(1, text), (2, "short one")], "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert plain.op2_byte_bpe(bpe.round_trip(docs, path, public_tokenizers.PATTERN).toPandas(), [(1, text), (2, "short one")]) == "equal"
    prints = simhash.fingerprints(docs).collect()
    assert {r.doc_id: r.print & (1 << 64) - 1 for r in prints} == {1: plain.simhash(text), 2: plain.simhash("short one")}
    trees = langid.learn(spark.createDataFrame([("word and more", "en"), ("mots et plus", "fr")], "text string, lang string"))
    assert {r.lang_pred for r in langid.predict(docs, trees).collect()} == {"en", "en"}
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), bucket_tokens=100_000)
    assert pieces.agg(F.sum("length")).first()[0] == sum(len(plain.english().encode(t, add_special_tokens=False).ids) + 1 for t in (text, "short one"))


def test_null_and_repeated_ids_of_the_other_operators(spark):
    rows = [(None, "an email a@b.cc here"), (None, None), (3, "same text of some words"), (3, "same text of some words"), (3, "other words")]
    docs = spark.createDataFrame([(*r, "en", 1, "x") for r in rows], "doc_id long, text string, lang string, score int, n_tokens string")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    trips = bpe.round_trip(docs, path, public_tokenizers.PATTERN).collect()
    assert len(trips) == 5 and sum(r.doc_id is None for r in trips) == 2 and sum(r.n_tokens == 0 for r in trips) == 1
    told = langid.identify(docs).collect()
    assert len(told) == 5 and all(r.held_out for r in told if r.doc_id is None)
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1)], "doc_id long, toxic int").withColumn("quality", F.lit(1))
    scores = toxicity.score_documents(docs, toxicity.learn(docs, labels)).collect()
    assert len(scores) == 5 and len({r.score for r in scores if r.doc_id == 3}) <= 2


def test_packing_holds_little_at_once():
    """The tokenizer's memory goes before packing, which needs none; pieces leave in batches of at most 4 MB of ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens.word_tokenizer(path).encode_all(["some words to remember"])
    tokens.forget_tokenizers()
    assert tokens.word_tokenizer.cache_info().currsize == 0
    for size in (2, 4):
        bucket = packing.Bucket(0, 1024, 256, size)
        bucket.open("", 1.0, 0.0)
        bucket.queues[""].extend([i, np.full(900, i, dtype=f"<u{size}").tobytes(), 0] for i in range(2000))
        batches = list(bucket.packed())
        assert max(b.num_rows for b in batches) <= 1024 + 2 and len(batches) > 2
        got = b"".join(ids for b in batches for ids in b.column("ids").to_pylist())
        assert len(got) == 4 * 900 * 2000 and sum(n for b in batches for n in b.column("length").to_pylist()) == 900 * 2000


def test_sizes_of_symbols_are_counted_once():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 9, 5000).astype("<u2")
    made, coded, _ = grammar.compress(ids, np.array([len(ids) - 1]))
    assert np.array_equal(made.decode(coded, made.sizes(coded)), ids) and np.array_equal(made.decode(coded), ids)
    empty = np.empty(0, dtype=np.int64)
    assert len(made.decode(empty, made.sizes(empty))) == 0


def test_encoding_leaves_the_collector_as_it_was():
    own = tokens.word_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_all(["a text"])
    assert gc.isenabled()
    gc.disable()
    try:
        own.encode_all(["another text"])
        assert not gc.isenabled()
    finally:
        gc.enable()


def test_words_with_signs_are_remembered_without_them():
    """A remembered word serves with any sign behind it, so that a worker's memory holds each word once."""
    own, library = tokens.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json")), plain.english()
    stems = [a + b for a in "abcdefghij" for b in ("lpha", "eta", "amma")]
    text = "Words " + " ".join(stem + sign for stem in stems for sign in ("", ",", ".", "!", "?", ";", "'s", ")."))
    assert np.frombuffer(own.encode_all([text])[0], own.dtype).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.known) <= len(stems) + 10


def test_ids_around_wide_white_space_and_when_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 300)
    monkeypatch.setattr(tokens, "LEARNT_WORDS", 7)
    monkeypatch.setattr(tokens, "PIECES", 20)
    own, library, rng = tokens.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json")), plain.english(), random.Random(3)
    parts = [*(chr(i) for i in range(0x80, 0x3001) if chr(i).isspace()), *" \n\t\r\x0b\x1c\x1f\x00.,'_", " ", " ", "'s", "'ll", "é", "”", "’", "日本", "½", "ÿ", "w" * 70, "word", "Word", " the", "́"]
    for _ in range(4):
        many = ["", " ", "\xa0 a", *("".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(400))]
        assert [np.frombuffer(raw, own.dtype).tolist() for raw in own.encode_all(many)] == [e.ids for e in library.encode_batch(many, add_special_tokens=False)]
        assert len(own.known) <= 300


def test_words_of_a_batch_are_looked_up_once():
    class Counting(dict):
        calls = 0

        def get(self, *a):
            self.calls += 1
            return super().get(*a)

        def __getitem__(self, key):
            self.calls += 1
            return super().__getitem__(key)

    own = tokens.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    own.known = Counting()
    text = "these are four words " * 5000
    assert np.frombuffer(own.encode_all([text])[0], own.dtype).tolist() == plain.english().encode(text, add_special_tokens=False).ids
    assert own.known.calls < 100


def test_a_worker_loads_the_library_once(monkeypatch):
    import tokenizers

    calls, load = [], tokenizers.Tokenizer.from_file
    monkeypatch.setattr(tokenizers, "Tokenizer", type("Loader", (), {"from_file": staticmethod(lambda path: calls.append(path) or load(path))}))
    own = tokens.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert own.by_word and len(calls) == 1
