"""Personal data and the terms that give it away, in DataFrame functions only.

Base spans (fixed patterns): e-mail addresses, IPv4 addresses, card numbers passing the
Luhn test and international phone numbers, leftmost and non-overlapping per kind.

On top of them, terms are judged by information theory on the whole corpus. A found
value (case folded) is a protected entity c; so are the levels it belongs to, which recur
where values do not: its mail domain, address prefix, card issuer or dialling prefix, and
its kind. The ``reach`` words on each side of its mentions are its context. With p(c) and
p(t) the shares of documents that hold the entity or the term and p(c, t) the share in
which the term stands in the entity's context, the disclosure of t about c is
PMI(c; t) / IC(c), where PMI = log(p(c, t) / (p(c) p(t))) = log(p(c | t) / p(c)) and
IC(c) = -log p(c): 1 when the term always comes with the entity, near 0 when they are
independent. A context word whose disclosure about a value or level reaches
``generalise_at`` becomes a class label, one that reaches ``remove_at`` goes.

Rare pairs are smoothed, not dropped: each text that a pair lacks to ``support`` distinct
ones is filled up with PRIOR texts that hold the term and, by chance only, the entity,
p(c | t) = (k + a p(c)) / (n + a) with a = PRIOR (support - k), where k are the distinct texts of
the pair and n the documents of the term a copy of these (copies of one text count as one).

Scale: mentions are extracted in one scan; contexts are combined per (entity, term)
before any shuffle; the document counts of terms are taken over all documents, combined
within each task. Counts of frequent entities, terms and pairs (at most OFTEN times the
mean number a document holds) are broadcast, the others dealt out, so that no key fills a
task. Texts are never shuffled: spans come back by a content key.

Regular expressions avoid repeated groups (a long text cannot exhaust the matcher's
stack): separators that belong to a value are first marked by characters of the same
length. Defined cases: a null text is empty; repeated rows get equal results; an empty
table gives no rows; other columns pass through ``sanitise`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.shared import written

REACH = 5
SUPPORT = 3
GENERALISE_AT = 0.6
REMOVE_AT = 0.9
PRIOR = 4
OFTEN = 1_000

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", TERM: "[TERM]"}

_A, _B = "\u0001", "\u0002"  # stand for a dot or blank, and a hyphen, inside a value
_SPAN = "array<struct<start:int,end:int,kind:string,value:string>>"


def pieces(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of a pattern's matches, in code points from 0."""
    values = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("found"))
    walked = F.aggregate(
        F.arrays_zip(values.alias("value"), F.slice(gaps, 1, F.size(values)).alias("gap")), start,
        lambda acc, m: F.struct(
            (acc["at"] + F.length(m["gap"]) + F.length(m["value"])).alias("at"),
            F.concat(acc["found"], F.array(F.struct(
                (acc["at"] + F.length(m["gap"])).alias("start"),
                (acc["at"] + F.length(m["gap"]) + F.length(m["value"])).alias("end"),
                m["value"].alias("value")))).alias("found")))
    return walked["found"]


def _valid_ip(value: Column) -> Column:
    return value.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum (every second digit from the right doubled, less 9 above 9) is a multiple of 10."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    total = F.aggregate(
        F.transform(F.filter(numbers, lambda d: d.isNotNull()),
                    lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)),
        F.lit(0), lambda acc, d: acc + d)
    return total % 10 == 0


def _kind(spans: Column, kind: str, test=None) -> Column:
    named = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                  F.lit(kind).alias("kind"), s["value"].alias("value")))
    return F.filter(named, lambda s: test(s["value"])) if test else named


def base_spans(text: Column) -> Column:
    """All base spans of a text (null: none), sorted by start, then kind as listed, then end."""
    none = F.array().cast(_SPAN)
    # marks of the text itself become another control character first
    clean = F.translate(F.coalesce(text, F.lit("")), _A + _B, "\u0003\u0003")
    dotted = F.regexp_replace(clean, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _A)
    email = pieces(dotted, rf"(?:\G|(?<![A-Za-z0-9._%+{_A}-]))[A-Za-z0-9._%+{_A}-]++@[A-Za-z0-9-]++{_A}[A-Za-z0-9{_A}-]++")
    ip = pieces(clean, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
    joined = F.regexp_replace(F.regexp_replace(clean, "(?<=[0-9]) (?=[0-9])", _A), "(?<=[0-9])-(?=[0-9])", _B)
    card = pieces(joined, f"[0-9][0-9{_A}{_B}]++")
    phone = pieces(clean, r"\+[0-9][ ().0-9-]+[0-9]")
    found = F.concat(
        F.when(clean.contains("@"), _kind(email, "email")).otherwise(none),
        F.when(clean.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), _kind(ip, "ip", _valid_ip)).otherwise(none),
        F.when(clean.rlike("[0-9](?:[ -]?[0-9]){13}"), _kind(
            card, "card", lambda v: F.length(_digits(v)).between(14, 19) & _luhn(_digits(v)))).otherwise(none),
        F.when(clean.contains("+"), _kind(phone, "phone", lambda v: F.length(_digits(v)).between(10, 15))).otherwise(none))
    order = F.create_map(*[x for i, k in enumerate((*KINDS, TERM)) for x in (F.lit(k), F.lit(i))])
    keyed = F.array_sort(F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
        s["value"].alias("value"))))
    # the values as they stand in the text (marks undone)
    return F.transform(keyed, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
        F.substring(F.coalesce(text, F.lit("")), s["start"] + 1, s["end"] - s["start"]).alias("value")))


def content_key() -> Column:
    """Equal for rows of equal doc_id and text, whatever the partitioning."""
    return F.md5(F.concat_ws("\u0000", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                             F.col("text").isNull().cast("string"), F.coalesce("text", F.lit("")))).alias("key")


TERM_PATTERN = r"[\p{L}][\p{L}\p{N}]*+"
_AROUND = 400


def _context(text: Column, span: Column, reach: int) -> Column:
    """The words on each side of a span, with their places; words cut by the view are left out."""
    low = F.greatest(span["start"] - _AROUND, F.lit(0))
    before = F.filter(pieces(F.substring(text, low + 1, span["start"] - low), TERM_PATTERN),
                      lambda w: (w["start"] > 0) | (low == 0))
    after = F.filter(pieces(F.substring(text, span["end"] + 1, F.lit(_AROUND)), TERM_PATTERN),
                     lambda w: (w["end"] < _AROUND))
    near = F.concat(
        F.transform(F.slice(before, F.greatest(F.size(before) - reach + 1, F.lit(1)), reach),
                    lambda w: F.struct((w["start"] + low).alias("start"), (w["end"] + low).alias("end"), F.lower(w["value"]).alias("term"))),
        F.transform(F.slice(after, 1, reach),
                    lambda w: F.struct((w["start"] + span["end"]).alias("start"), (w["end"] + span["end"]).alias("end"), F.lower(w["value"]).alias("term"))))
    return near


def mentions(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, key, spans, contexts): base spans of every document and the words around them."""
    spans = docs.select("doc_id", "text", content_key(), base_spans(F.col("text")).alias("spans"))
    around = F.flatten(F.transform("spans", lambda s: F.transform(
        F.filter(_context(F.col("text"), s, reach),
                 lambda w: ~F.exists("spans", lambda o: (o["start"] < w["end"]) & (w["start"] < o["end"]))),
        lambda w: F.struct(s["kind"].alias("kind"), s["value"].alias("value"), w["term"].alias("term"),
                           w["start"].alias("start"), w["end"].alias("end")))))
    empty = F.array().cast("array<struct<kind:string,value:string,term:string,start:int,end:int>>")
    return spans.select("doc_id", "key", F.md5(F.coalesce("text", F.lit(""))).alias("content"), "spans",
                        F.when(F.size("spans") > 0, around).otherwise(empty).alias("contexts"))


def levels(kind: Column, value: Column) -> Column:
    """A value's entities: itself (case folded), its domain, prefix or issuer, and its kind."""
    value, digits = F.lower(value), _digits(value)
    wider = (F.when(kind == "email", F.substring_index(value, "@", -1)).when(kind == "ip", F.substring_index(value, ".", 3))
             .when(kind == "card", F.substring(digits, 1, 6)).otherwise(F.substring(digits, F.lit(1), F.length(digits) - 7)))
    return F.array(value, F.concat_ws(" ", kind, wider), kind)


def _with_counts(rows: DataFrame, counts: DataFrame, on: list[str], count: str, total: int) -> DataFrame:
    """The inner join with counts: those above ``total`` / OFTEN are few and are broadcast, the others dealt out."""
    often = F.col(count) * OFTEN > total
    many = F.broadcast(counts.where(often))
    return rows.join(many, on).unionByName(rows.join(many.select(*on), on, "left_anti").join(counts.where(~often), on))


def disclosing_terms(docs: DataFrame, found: DataFrame, support: int = SUPPORT,
                     generalise_at: float = GENERALISE_AT) -> DataFrame:
    """(entity, term, n_both, disclosure) from ``generalise_at`` on; ``found`` is the output of ``mentions``."""
    total = docs.count()
    # one row per document first: a term that stands twice near an entity counts once
    near = F.array_distinct(F.flatten(F.transform("contexts", lambda c: F.transform(
        levels(c["kind"], c["value"]), lambda e: F.struct(e.alias("entity"), c["term"].alias("term"))))))
    pair = (found.select("content", F.explode(near).alias("c")).groupBy("content", "c.entity", "c.term").agg(F.count("*").alias("n"))
            .groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("texts")))
    pair = written(pair, "pairs")
    held = F.array_distinct(F.flatten(F.transform("spans", lambda s: levels(s["kind"], s["value"]))))
    entity = written(found.select(F.explode(held).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity")), "entities")
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM_PATTERN), 0))).alias("term"))
    # an inner join with distinct terms: a semi-join would be moved below the aggregation
    term = words.groupBy("term").agg(F.count("*").alias("n_term")).join(pair.select("term").distinct(), "term")
    pair = _with_counts(pair, entity, ["entity"], "n_entity", total)
    pair = _with_counts(written(pair, "pairs"), written(term, "terms"), ["term"], "n_term", total)
    share = F.col("n_entity") / F.lit(float(total))
    missing = PRIOR * F.greatest(F.lit(support) - F.col("texts"), F.lit(0))
    chance = (F.col("texts") + missing * share) / (F.col("n_term") * F.col("texts") / F.col("n_both") + missing)
    return (pair.withColumn("disclosure", F.when(share < 1, F.round(F.log(chance / share) / -F.log(share), 9)).otherwise(F.lit(0.0)))
            .where(F.col("disclosure") >= generalise_at).select("entity", "term", "n_both", "disclosure"))


def term_spans(docs: DataFrame, found: DataFrame, support: int = SUPPORT, generalise_at: float = GENERALISE_AT,
               remove_at: float = REMOVE_AT) -> DataFrame:
    """(key, terms): the spans of disclosing context words, each once, with its strongest disclosure."""
    told = written(disclosing_terms(docs, found, support, generalise_at), "told")
    met = (found.dropDuplicates(["key"]).select("key", F.explode("contexts").alias("c"))
           .select("key", F.explode(levels(F.col("c.kind"), F.col("c.value"))).alias("entity"), "c.term", "c.start", "c.end"))
    return (_with_counts(met, told, ["entity", "term"], "n_both", docs.count())
            .groupBy("key", "start", "end").agg(F.max("disclosure").alias("disclosure"))
            .groupBy("key").agg(F.array_sort(F.collect_list(F.struct(
                "start", "end", F.lit(TERM).alias("kind"), (F.col("disclosure") >= remove_at).alias("remove")))).alias("terms")))


def personal_data(docs: DataFrame, reach: int = REACH, support: int = SUPPORT,
                  generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """(doc_id, spans, terms) of every document: base spans, and spans of disclosing terms."""
    found = written(mentions(docs, reach), "mentions")
    terms = term_spans(docs, found, support, generalise_at, remove_at)
    return (found.join(terms, "key", "left")
            .select("doc_id", "spans", F.coalesce("terms", F.array().cast(
                "array<struct<start:int,end:int,kind:string,remove:boolean>>")).alias("terms")))


def rewrite(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its label; of overlapping spans the first, then the longest, decides."""
    spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("longest"),
                                                  s["end"].alias("end"), s["label"].alias("label")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(F.array_sort(spans), start, lambda acc, s: F.when(
        s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), s["label"])).alias("out")))
        .otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))))
    return F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text)))


BROADCAST_DOCUMENTS = 50_000


def sanitise(docs: DataFrame, reach: int = REACH, support: int = SUPPORT,
             generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """The documents, with their columns, whose texts have labels for personal data and disclosing terms."""
    found = written(mentions(docs, reach).where(F.size("spans") > 0), "mentions")
    terms = written(term_spans(docs, found, support, generalise_at, remove_at), "terms")
    few = terms.count() <= BROADCAST_DOCUMENTS and (terms.agg(F.sum(F.size("terms"))).first()[0] or 0) <= 20 * BROADCAST_DOCUMENTS
    side = F.broadcast(terms) if few else terms.hint("shuffle_hash")
    side = side.select(F.col("key").alias("key of this text"), "terms")
    label = F.create_map(*[F.lit(x) for k in LABELS.items() for x in k])
    spans = F.concat(
        F.transform(base_spans(F.col("text")), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), label[s["kind"]].alias("label"))),
        F.coalesce(F.transform("terms of this text", lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.when(s["remove"], "").otherwise(label[s["kind"]]).alias("label"))),
            F.array().cast("array<struct<start:int,end:int,label:string>>")))
    joined = docs.join(side.withColumnRenamed("terms", "terms of this text"), content_key() == F.col("key of this text"), "left")
    return joined.withColumn("text", F.when(F.col("text").isNotNull(), rewrite(F.col("text"), spans))).select(*docs.columns)
