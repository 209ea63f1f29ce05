"""PII: patterns find personal data, and corpus statistics find the terms that give it away.

Built-in expressions only. No text goes through Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.operators.lookup import fits_broadcast, lookup
from dialogprep.sources.storage import stage

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: The patterns of the four kinds. A match starts where a run of its first characters starts, or where the match
#: before ended, so long runs are not tried again from each place; groups are possessive, so they need no stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to be looked for.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
WORD = r"[\p{L}\p{N}]{3,}"
#: Entities of a document that one task pairs with its terms.
ENTITIES = 256
#: Share of an entity's information that a term may give away, and the documents that must show it.
DISCLOSURE, SUPPORT = 0.9, 3


def places(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """array<struct<start, end, value>> of all matches, or of those to keep, in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(at: Column, x: Column) -> Column:
        start = at["at"] + x["gap"]
        end = start + F.length(x["value"])
        out = F.array_append(at["out"], F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))
        out = out if keep is None else F.when(keep(x["value"]), out).otherwise(at["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    steps = F.zip_with(found, F.slice(gaps, 1, F.greatest(F.size(found), F.lit(0))), lambda v, g: F.struct(v.alias("value"), g.alias("gap")))
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    return F.when(F.size(found) > 0, F.aggregate(steps, start, step, lambda a: a["out"])).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = digit * F.when(i % 2 == 0, 2).otherwise(1)
        return total + twice - F.when(twice > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"\."), lambda p: F.coalesce(p.cast("double") <= 255, F.lit(False))),
    "card": lambda v: F.when(F.length(_digits(v)).between(12, 19), _luhn(_digits(v))).otherwise(F.lit(False)),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}
#: What makes two mentions the same entity.
ENTITY: dict[str, Callable[[Column], Column]] = {"email": F.lower, "ip": lambda v: v, "card": _digits, "phone": _digits}


def base_spans(text: Column) -> Column:
    """array<struct<start, rank, end, kind, entity>> of the four kinds, by start, then kind as listed."""
    return F.array_sort(F.concat(*[_spans_of(text, rank, kind) for rank, kind in enumerate(KINDS)]))


def _spans_of(text: Column, rank: int, kind: str) -> Column:
    def span(s: Column) -> Column:
        entity = F.concat(F.lit(kind + ":"), ENTITY[kind](s["value"]))
        return F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), entity.alias("entity"))

    found = places(text, PATTERNS[kind], VALID[kind])
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,entity:string>>")
    return F.when(F.contains(text, F.lit(NEEDS[kind])), F.transform(found, span)).otherwise(empty)


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, terms) of each row: spans of the four kinds, and of terms that disclose an entity.

    A term is weighed by how many documents it shares with an entity, anywhere in them, against how many each is
    in: their pointwise mutual information as a share of the entity's own information, log2(N / n(entity)). It is
    1 for a term that is found with the entity alone. From DISCLOSURE on, in SUPPORT documents at least, the term
    gives the entity away by itself, so all its places in all documents become spans, in those without the
    entity too. Terms are counted over all documents.

    A document's entities meet its terms only where their counts allow it: with n(both) at most n(entity), a term
    of more than n(entity) * (N / n(entity)) ** (1 - DISCLOSURE) documents cannot give the entity away.

    Rows with the same id and text are one document: they count once, and are found the same spans. Entities that
    stand in the same documents are weighed once, as all their numbers are the same; so a page of many addresses
    costs no more than one. A null text is empty. An empty table gives an empty result. Spans of terms never overlap
    base spans.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    of_doc = F.xxhash64("doc_id", "text_hash").alias("doc")
    base = stage(rows.select("doc_id", "text_hash", of_doc, base_spans(F.col("text")).alias("base")), "base-spans")
    sizes = base.groupBy("doc").agg(F.count("*").alias("rows"))
    n = max(2, sizes.count())
    repeated = stage(sizes.where("rows > 1").select("doc"), "repeated")
    once = _once(rows.select(of_doc, "text"), repeated)

    entities = _once(base.select("doc", "base"), repeated)
    entities = entities.select("doc", F.explode(F.array_distinct(F.transform("base", lambda s: s["entity"]))).alias("entity"))
    # entities of the same documents: one of them stands for all
    classes = entities.groupBy("entity").agg(F.count("*").alias("n_entity"), F.bit_xor(F.xxhash64("doc")).alias("x"), F.bit_xor(F.xxhash64("doc", F.lit("again"))).alias("y"))
    classes = classes.where(F.col("n_entity") >= SUPPORT).groupBy("n_entity", "x", "y").agg(F.min("entity").alias("entity"))
    entities = stage(_known(entities, classes.select("entity", "n_entity"), "entity", "n_entity"), "entities")
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
    terms = once.select("doc", F.explode(words).alias("term"))
    n_term = terms.groupBy("term").agg(F.count("*").alias("n_term")).where(F.col("n_term") >= SUPPORT)
    most = F.col("n_entity") * F.pow(F.lit(float(n)) / F.col("n_entity"), F.lit(1 - DISCLOSURE)) * 1.000001
    bound = entities.agg(F.max(most)).first()[0]
    own = once.join(entities.select("doc").distinct(), "doc", "left_semi").select("doc", F.explode(words).alias("term"))
    own = _known(own, n_term.where(F.col("n_term") <= F.lit(float(bound or 0))), "term", "n_term")
    both = _paired(own, entities).where(F.col("n_term") <= most).groupBy("entity", "term", "n_entity", "n_term").agg(F.count("*").alias("n_both"))
    gain = F.log2(F.lit(float(n)) * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    own_gain = F.log2(F.lit(float(n)) / F.col("n_entity"))
    telling = both.where((F.col("n_both") >= SUPPORT) & (own_gain > 0) & (gain >= DISCLOSURE * own_gain)).select("term").distinct()
    told = _known(terms, telling.withColumn("tells", F.lit(True)), "term", "tells").groupBy("doc").agg(F.collect_set("term").alias("own"))
    spans = rows.select("doc_id", "text_hash", of_doc, "text").join(told, "doc")
    found = places(F.col("text"), WORD, lambda v: F.array_contains("own", F.lower(v)))
    spans = spans.select(F.col("doc_id").alias("t_id"), F.col("text_hash").alias("t_hash"), F.transform(found, lambda s: F.struct(s["start"], s["end"])).alias("found"))
    spans = spans.dropDuplicates(["t_id", "t_hash"])
    joined = base.join(spans, F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("text_hash") == F.col("t_hash")), "left")
    apart = F.filter("found", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return joined.select("doc_id", "text_hash", "base", F.coalesce(apart, empty).alias("terms"))


def _once(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """One row of each ``doc``; only those that repeat are shuffled, and each task folds its own first."""
    if repeated.isEmpty():
        return rows
    known = F.broadcast(repeated) if fits_broadcast(repeated) else repeated
    return rows.join(known, "doc", "left_anti").unionByName(rows.join(known, "doc", "left_semi").dropDuplicates(["doc"]))


def _known(rows: DataFrame, known: DataFrame, key: str, told: str) -> DataFrame:
    """The rows, which have a ``doc``, whose key is known, with the column ``told`` of it, which is never null.

    What is known is broadcast if it is measured to be small. Else it is shuffled, and rows of hot keys are spread.
    """
    return lookup(rows, stage(known, "known"), [key], "doc").where(F.col(told).isNotNull())


def _paired(own: DataFrame, entities: DataFrame) -> DataFrame:
    """The terms of each document with its entities; a document of many entities is dealt to several tasks."""
    parts = entities.groupBy("doc").agg(F.ceil(F.count("*") / F.lit(ENTITIES)).cast("int").alias("parts")).where("parts > 1")
    parts = stage(parts, "long-lists")
    if parts.isEmpty():
        return own.join(entities, "doc")
    known = F.broadcast(parts) if fits_broadcast(parts) else parts
    n = F.coalesce("parts", F.lit(1))
    dealt = entities.join(known, "doc", "left").withColumn("part", F.pmod(F.xxhash64("entity"), n).cast("int")).drop("parts")
    copies = own.join(known, "doc", "left").withColumn("part", F.explode(F.sequence(F.lit(0), n - 1))).drop("parts")
    return copies.join(dealt, ["doc", "part"]).drop("part")


def _listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _all_spans() -> Column:
    """Base and term spans as array<struct<start, rank, end, kind>>, in order."""
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    terms = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), s["end"].alias("end"), F.lit(TERM).alias("kind")))
    return F.array_sort(F.concat(base, terms))


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term) of each row."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in KINDS]
    return find_spans(docs).select(
        "doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(_all_spans()).alias("spans"), F.size("terms").cast("long").alias("n_term")
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with each span of the text replaced by its kind, as in ``<email>``.

    Overlapping spans become one, named by the first. Telling terms are generalised to ``<term>``. A null text
    stays null; a text without spans stays as it is.
    """
    spans = find_spans(docs).select(F.col("doc_id").alias("__s_id"), F.col("text_hash").alias("__s_hash"), _all_spans().alias("__s_spans")).where(F.size("__s_spans") > 0)
    spans = spans.dropDuplicates(["__s_id", "__s_hash"])
    joined = docs.join(spans, docs["doc_id"].eqNullSafe(F.col("__s_id")) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("__s_hash")), "left")
    masked = F.when(F.col("__s_spans").isNull(), docs["text"]).otherwise(_masked(docs["text"], F.col("__s_spans")))
    return joined.select(*[masked.alias(c) if c == "text" else docs[c] for c in docs.columns])


def _masked(text: Column, spans: Column) -> Column:
    """Pieces between spans, each read once from where the furthest span before it ended."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0))), F.lit("<"), s["kind"], F.lit(">"))
        fresh = (s["start"] >= a["at"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(fresh, F.array_append(a["out"], piece)).otherwise(a["out"]).alias("out"))

    rest = lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text)))
    return F.aggregate(spans, start, step, rest)
