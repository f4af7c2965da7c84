"""PII (1): information-theoretic sanitisation, in DataFrame functions only.

Base entities (email, ip, card, phone) are found by pattern in every whole text.  How
strongly a term gives an entity of its document away is estimated from the corpus: with D
documents, df(e) those with entity e, df(t) those with term t and df(e, t) those with both,
anywhere in the text,

    information of e     IC(e)     = log2(D / df(e))
    disclosure by t      PMI(e; t) = log2(P(e | t) D / df(e))
                         P(e | t)  = (df(e, t) + PSEUDO df(e) / D) / (df(t) + PSEUDO)

``PSEUDO`` documents at the entity's own rate smooth small counts, so an entity or a term
of one document is judged like any other, with less certainty.  A term that carries at
least ``REMOVE`` of the entity's information is removed wherever it stands in the
document, one with at least ``GENERALISE`` is generalised to its shape; the entity must
have more than one bit.  A term is a run of letters outside the base entities.

All counts are map-side aggregates keyed by 64-bit hashes, so a value or word in a third of
the rows costs one row per task; texts are never shuffled.  The pairs of a document are its
distinct entities times its distinct terms.

Cases: null and empty texts have no spans; rows that repeat a doc_id are reported each;
a null doc_id is reported like others; positions count code points; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import cut, read_table

#: Base kinds in their fixed order and their patterns.  Possessive forms and the guards
#: (start of a run, or where the last match ended) match the same spans as the plain
#: forms but never go back, so one long run costs linear time.
KINDS = ("email", "ip", "card", "phone", "removed", "generalised")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for its kind to be looked for at all.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

TERM = r"\p{L}{3,}"
PSEUDO = 1.0
REMOVE, GENERALISE = 0.95, 0.75
#: Words whose places are added up at once: appending to long arrays costs the square.
FOLD = 256

SPAN = "struct<s:int,kind:int,e:int,v:string>"


def _matches(text: str, pattern: str, kind: int) -> str:
    """SQL: the pattern's leftmost matches in ``text`` as spans, with their places.

    Splitting at the pattern gives what lies between the matches; lengths add up to places.
    """
    quoted = "r'" + pattern + "'"
    return f"""aggregate(
      arrays_zip(split({text}, {quoted}, -1), regexp_extract_all({text}, {quoted}, 0)),
      named_struct('at', 0, 'out', cast(array() AS array<{SPAN}>)),
      (acc, x) -> named_struct(
        'at', acc.at + length(x.`0`) + coalesce(length(x.`1`), 0),
        'out', if(x.`1` IS NULL, acc.out, concat(acc.out, array(named_struct(
          's', acc.at + length(x.`0`), 'kind', {kind}, 'e', acc.at + length(x.`0`) + length(x.`1`), 'v', x.`1`))))),
      acc -> acc.out)"""


_LUHN = """aggregate(sequence(1, length({d})), 0L, (a, i) -> a + CASE
  WHEN i % 2 = 0 THEN (2 * cast(substr({d}, length({d}) - i + 1, 1) AS int)) div 10
                    + (2 * cast(substr({d}, length({d}) - i + 1, 1) AS int)) % 10
  ELSE cast(substr({d}, length({d}) - i + 1, 1) AS int) END) % 10 = 0"""
_CARD, _PHONE = "regexp_replace(x.v, r'[\\x20-]', '')", "regexp_replace(x.v, r'[^0-9]', '')"
VALID = {
    "email": "true",
    "ip": r"forall(split(x.v, r'\.', -1), q -> cast(q AS double) <= 255)",
    "card": f"if(length({_CARD}) BETWEEN 12 AND 19, {_LUHN.format(d=_CARD)}, false)",
    "phone": f"length({_PHONE}) BETWEEN 9 AND 15",
}


def base_spans(text: str) -> Column:
    """Valid base spans of the column named ``text`` (not null), by start, then kind."""
    none = f"cast(array() AS array<{SPAN}>)"
    parts = []
    for k, kind in enumerate(KINDS[:4]):
        need = f"instr({text}, '{NEEDS[kind]}') > 0 AND " if NEEDS[kind] else ""
        parts.append(
            f"if({need}{text} RLIKE '[A-Za-z0-9]', filter({_matches(text, PATTERNS[kind], k)}, x -> {VALID[kind]}), {none})"
        )
    return F.expr(f"array_sort(concat({', '.join(parts)}))")


def _words(text: str) -> str:
    """SQL: all terms of ``text``, (w, s, e) with the hash of the lower-cased term, in two levels of ``FOLD``."""
    quoted = "r'" + TERM + "'"
    word = "struct<w:bigint,s:int,e:int>"
    return f"""element_at(transform(
      array(arrays_zip(split({text}, {quoted}, -1), regexp_extract_all({text}, {quoted}, 0))),
      z -> aggregate(
        transform(sequence(0, (size(z) - 1) div {FOLD}), c -> aggregate(
          slice(z, cast(c * {FOLD} + 1 AS int), {FOLD}),
          named_struct('at', 0, 'out', cast(array() AS array<{word}>)),
          (acc, x) -> named_struct(
            'at', acc.at + length(x.`0`) + coalesce(length(x.`1`), 0),
            'out', if(x.`1` IS NULL, acc.out, concat(acc.out, array(named_struct(
              'w', xxhash64(lower(x.`1`)), 's', acc.at + length(x.`0`), 'e', acc.at + length(x.`0`) + length(x.`1`)))))))),
        named_struct('at', 0, 'out', cast(array() AS array<array<{word}>>)),
        (acc, part) -> named_struct('at', acc.at + part.at, 'out', concat(acc.out, array(
          transform(part.out, y -> named_struct('w', y.w, 's', acc.at + y.s, 'e', acc.at + y.e))))),
        acc -> flatten(acc.out))), 1)"""


def found_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, base, ents, words, hidden)`` of every row, written.

    Base spans, hashes of the distinct entities, all terms outside the spans with their
    places, and hashes of the words that stand inside spans only; a text without base
    spans has none of them.  ``th`` is a hash of the text that tells rows of one doc_id apart.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    texts = texts.withColumn("base", base_spans("t"))
    ents = F.array_distinct(F.transform("base", lambda b: F.xxhash64(F.concat_ws(":", b["kind"], F.lower(b["v"])))))
    every = F.expr(f"if(size(base) = 0, NULL, {_words('t')})")
    out = texts.select("doc_id", F.xxhash64("t").alias("th"), "base", ents.alias("ents"), every.alias("every"))
    out = out.withColumn("words", F.expr("filter(every, y -> NOT exists(base, b -> b.s < y.e AND y.s < b.e))"))
    hidden = F.array_except(F.col("every.w"), F.col("words.w"))
    return cut(out.select("doc_id", "th", "base", "ents", "words", hidden.alias("hidden")), "pii-base")


def disclosing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``(doc_id, th, w, kind)``: the terms of each document that give an entity of it away; kind is an index of KINDS. Written."""
    n_docs = docs.count()
    df_e = found.select(F.explode("ents").alias("ent")).groupBy("ent").agg(F.count("*").alias("df_e"))
    terms = found.select("doc_id", "th", "ents", F.explode(F.array_distinct(F.col("words.w"))).alias("w"))
    pairs = terms.select("doc_id", "th", "w", F.explode("ents").alias("e"))
    df_et = cut(pairs.groupBy("e", "w").agg(F.count("*").alias("df_et")), "pii-pairs")
    words = F.array_distinct(F.expr(f"transform(regexp_extract_all(text, r'{TERM}', 0), w -> xxhash64(lower(w)))"))
    df_t = docs.select(F.explode(words).alias("t_w"), F.lit(1).alias("n"))
    df_t = df_t.unionAll(found.select(F.explode("hidden"), F.lit(-1)))
    df_t = df_t.groupBy("t_w").agg(F.sum("n").alias("df_t"))
    scored = (
        df_et.join(df_t, F.col("w") == F.col("t_w"))
        .join(cut(df_e, "pii-entities"), F.col("e") == F.col("ent"))
        .withColumn("rate", F.col("df_e") / F.lit(float(n_docs)))
        .withColumn("ic", -F.log2("rate"))
        .withColumn("pmi", F.log2((F.col("df_et") + PSEUDO * F.col("rate")) / (F.col("df_t") + PSEUDO) / F.col("rate")))
        .filter((F.col("ic") > 1) & (F.col("pmi") >= GENERALISE * F.col("ic")))
    )
    kind = F.when(F.col("pmi") >= REMOVE * F.col("ic"), KINDS.index("removed")).otherwise(KINDS.index("generalised"))
    scored = cut(scored.select(F.col("e").alias("d_e"), F.col("w").alias("d_w"), kind.alias("kind")), "pii-terms")
    # a term that gives two entities away is taken once, at its stricter (smaller) kind
    own = pairs.join(scored, (F.col("e") == F.col("d_e")) & (F.col("w") == F.col("d_w")))
    return cut(own.groupBy("doc_id", "th", "w").agg(F.min("kind").alias("kind")), "pii-disclosing")


def spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, base, spans)`` of every row; spans holds base and disclosing ones, sorted."""
    found = found_spans(docs)
    terms = disclosing(docs, found).withColumnsRenamed({"doc_id": "d_id", "th": "d_th"})
    places = found.select("doc_id", "th", F.explode("words").alias("y"))
    same = F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("th") == F.col("d_th")) & (F.col("y.w") == F.col("w"))
    span = F.struct(F.col("y.s").alias("s"), F.col("kind"), F.col("y.e").alias("e"), F.lit("").alias("v"))
    by_doc = places.join(terms, same).groupBy(F.col("doc_id").alias("h_id"), F.col("th").alias("h_th"))
    by_doc = cut(by_doc.agg(F.collect_set(span).alias("own")), "pii-hits")
    joined = found.join(by_doc, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("th") == F.col("h_th")), "left")
    none = F.expr(f"cast(array() AS array<{SPAN}>)")
    return joined.select("doc_id", "th", "base", F.array_sort(F.concat("base", F.coalesce("own", none))).alias("spans"))


def sanitised(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with entities named by kind, disclosing terms removed or generalised to ``*``."""
    found = spans(docs).select(F.col("doc_id").alias("s_id"), "th", "spans").dropDuplicates(["s_id", "th"])
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    label = "CASE x.kind WHEN 0 THEN '[EMAIL]' WHEN 1 THEN '[IP]' WHEN 2 THEN '[CARD]' WHEN 3 THEN '[PHONE]' WHEN 4 THEN '' ELSE '*' END"
    text = F.expr(
        f"""aggregate(spans, named_struct('at', 0, 'out', ''),
          (acc, x) -> if(x.s < acc.at, named_struct('at', greatest(acc.at, x.e), 'out', acc.out),
            named_struct('at', x.e, 'out', concat(acc.out, substring(t, acc.at + 1, x.s - acc.at), {label}))),
          acc -> concat(acc.out, substring(t, acc.at + 1)))"""
    )
    on = F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.xxhash64("t") == F.col("th"))
    return texts.join(found, on).select("doc_id", text.alias("text"))


def _listing(column: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(
        f"array_join(transform({column}, x -> concat_ws(':', element_at(array({names}), x.kind + 1), x.s, x.e)), ',')"
    )


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(read_table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])],
        F.sha2(_listing("base"), 256).alias("base_sha256"),
        _listing("spans").alias("spans"),
    )
