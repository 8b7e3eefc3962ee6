"""The operators over their whole tables with production parameters, and SQL where it can say the same."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewright.llm import (
    decontaminate,
    jaccard_join,
    language_id,
    licenses,
    line_dedup,
    maxent_lm,
    multi_index,
    pieces,
    quality_crf,
    quality_rules,
    ranked_search,
    token_counts,
    toxicity,
)
from candlewright.session import materialize

#: Where the tokenizer's model file is; read on the driver alone.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


#: The pipeline's near copies: sets of five words, similarity 0.8. The op5 query has its own setting.
STAGE_COPIES = jaccard_join.JoinParams(size=5, percent=80)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def held_out(id_col: str, divisor: int, rest: int) -> Column:
    return F.coalesce(remainder(id_col, divisor) == rest, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with all evidence; documents, which have no markup or address, with their source as host."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language_id.fit_text(docs)
    null = F.lit(None)
    rows = pages.select(
        F.struct(F.col("page_id"), null.cast("bigint").alias("doc_id")).alias("key"),
        F.col("html").alias("body"),
        F.lit(True).alias("is_page"),
        language_id.host_of(F.col("url")).alias("host"),
        language_id.declared(F.col("html")).alias("markup"),
        language_id.address_code(F.col("url")).alias("code"),
    ).unionAll(
        docs.select(
            F.struct(null.cast("bigint").alias("page_id"), F.col("doc_id")),
            F.col("text"),
            F.lit(False),
            F.col("source"),
            null.cast("string"),
            null.cast("string"),
        )
    )
    found = language_id.identify(rows, model)
    return found.select("key.page_id", "key.doc_id", "language", "probability", "text_language")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.clean(table(spark, sf_dir, "documents"))
    return done.select("doc.doc_id", "n_lines", "n_removed", F.col("cleaned").alias("text"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored, model = maxent_lm.train_and_score(docs, remainder("doc_id", 10) == 0)
    return scored.select(
        F.col("id").alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = pieces.round_trip(docs, pieces.load_vocabulary(PIECE_MODEL))
    return done.select(
        F.col("id").alias("doc_id"),
        F.size("pieces").cast("bigint").alias("n_pieces"),
        "n_bytes",
        F.col("same").alias("decodes_back"),
        "pieces",
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.groups(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "start", "size", "similarity"
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    measured = quality_rules.measures(docs)
    measured = materialize(measured.select("doc.doc_id", *measured.columns[1:]), "measures")
    judged = quality_rules.judge(measured, quality_rules.fit(measured))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "posterior",
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = table(spark, sf_dir, "labels").where(~held_out("doc_id", 5, 0))
    params = toxicity.ToxicParams()
    model = toxicity.fit(*toxicity.sample(docs, known, params, "doc_id", "text", "toxic"), params)
    keys = [F.col("doc_id"), held_out("doc_id", 5, 0).alias("held_out")]
    scored = toxicity.score(docs, model, keys)
    return scored.select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.col("worst").alias("worst_sentence"),
        F.col("worst_score").alias("sentence_score"),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("dice", F.round("dice", 6))


def op10_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = table(spark, sf_dir, "labels").where(~held_out("doc_id", 4, 2))
    params = quality_crf.CrfParams()
    model = quality_crf.fit(*quality_crf.sample(docs, known, params, "doc_id", "text", "quality"), params)
    keys = [F.col("doc_id"), held_out("doc_id", 4, 2).alias("held_out")]
    scored = quality_crf.score(docs, model, keys)
    return scored.select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "n_lines",
        "n_bad",
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = token_counts.load_model(PIECE_MODEL)
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), model)
    return counted.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").where(multi_index.usable(F.col("embedding")))
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select(
        F.col("vec_id").alias("id"),
        shifted.alias("label"),
        multi_index.whole_numbers(F.col("embedding"), 256).alias("z"),
    )
    found = multi_index.hard_negatives(rows, F.col("id") % 50 == 0)
    return found.select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("negative").alias("negative_id"),
        "positive_score",
        "negative_score",
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


# --- stages of the pipeline; each returns the columns of its input ---------------------


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules reject go."""
    measured = quality_rules.measures(docs)
    counted = materialize(measured.drop("doc"), "measures")
    judged = quality_rules.judge(measured, quality_rules.fit(counted))
    return judged.where("kept").select("doc.*")


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, and with them documents that had nothing else."""
    done = line_dedup.clean(docs).where("n_removed = 0 or n_removed < n_lines")
    changed = F.col("n_removed") > 0
    columns = []
    for name in docs.columns:
        own = F.col(f"doc.{name}")
        if name == "text":
            own = F.col("cleaned")
        elif name == "n_chars":
            kind = docs.schema["n_chars"].dataType
            own = F.when(changed, F.length("cleaned").cast(kind)).otherwise(own)
        columns.append(own.alias(name))
    return done.select(*columns)


def stage_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Rows are told apart by id and text, so a row without an id, or with another one's, goes only for
    its own text. Documents without words stay. Of rows with the same id and text one stays.
    """
    rows = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    found = jaccard_join.groups(rows, STAGE_COPIES, "key").where("node is not null")
    found = materialize(found.select(F.col("id").alias("key"), "component"), "copies")
    several = found.where("key <> component").select("component").distinct()
    members = found.join(several, "component", "left_semi").distinct()
    named = rows.select("key", "doc_id").join(members, "key")
    named = materialize(named, "members")
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    first = named.groupBy("component").agg(F.min(rank)["key"].alias("first"))
    lost = named.join(first, "component").where("key <> first")
    lost = materialize(lost.select(F.col("key").alias("lost"), F.col("doc_id").alias("lost_id")).distinct(), "lost")
    same = (F.xxhash64("rest.doc_id", "rest.text") == F.col("lost")) & F.col("rest.doc_id").eqNullSafe(F.col("lost_id"))
    rest = docs.select(F.struct("*").alias("rest")).join(lost, same, "left_anti").select("rest.*")
    return rest.dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def stage_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go, told apart by id and text."""
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    found = decontaminate.leaks(docs.select(key.alias("key"), "text"), table(spark, sf_dir, "benchmark"), id_col="key")
    lost = found.select(F.col("id.id").alias("lost_id"), F.col("id.text").alias("lost")).distinct()
    lost = materialize(lost, "leaks")
    same = (F.xxhash64("rest.text") == F.col("lost")) & F.col("rest.doc_id").eqNullSafe(F.col("lost_id"))
    return docs.select(F.struct("*").alias("rest")).join(lost, same, "left_anti").select("rest.*")


def stage_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document that is left."""
    done = pieces.encode(docs, pieces.load_vocabulary(PIECE_MODEL))
    return done.select(
        F.col("id").alias("doc_id"), F.size("pieces").cast("bigint").alias("n_pieces"), "n_bytes", "pieces"
    )


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_decontamination": op6_decontamination,
    "op7_quality_rules": op7_quality_rules,
    "op8_toxicity": op8_toxicity,
    "op9_licenses": op9_licenses,
    "op10_quality_crf": op10_quality_crf,
    "op11_token_counts": op11_token_counts,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_ranked_search": op13_ranked_search,
}


def _op2_sql() -> str:
    sites = line_dedup.LineParams().min_sites
    around = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"
    return f"""
with lines as (
  select doc_id, source, pos, line, trim(line, {around}) as key
  from (select doc_id, source, generate_subscripts(l, 1) as pos, unnest(l) as line
        from (select doc_id, source, string_split(coalesce(text, ''), chr(10)) as l from documents))),
common as (
  select key, min(doc_id) as first_id from lines where key <> ''
  group by key having count(distinct coalesce(source, chr(10))) >= {sites}),
judged as (
  select l.doc_id, l.pos, l.line, l.key,
         c.key is not null and not (
           l.doc_id = c.first_id
           and l.pos = min(l.pos) over (partition by l.doc_id, l.key)) as gone
  from lines l left join common c on l.key = c.key)
select d.doc_id, count(*) filter (j.key <> '') as n_lines, count(*) filter (j.gone) as n_removed,
       case when count(*) filter (j.gone) = 0 then any_value(d.text)
            else coalesce(string_agg(j.line, chr(10) order by j.pos) filter (not j.gone), '') end as text
from documents d join judged j using (doc_id) group by d.doc_id"""


def _op9_sql() -> str:
    rows = ", ".join(
        "('{}#{:03d}', '{}')".format(name, k, body.replace("'", "''"))
        for k, (name, body) in enumerate(licenses.TEMPLATES)
    )

    def normal(column: str) -> str:
        return f"list_filter(string_split_regex(lower({column}), '[^a-z0-9]+'), lambda x: x <> '')"

    def pairs(words: str) -> str:
        return f"list_distinct(list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))"

    return f"""
with named as (select template, {normal("body")} as w from (values {rows}) v(template, body)),
known as (select template, len(w) as size, {pairs("w")} as pairs from named where len(w) >= 2),
longest as (select max(len(pairs)) * 1.5 + 1 as words from known),
texts as (
  select distinct doc_id, text, {normal("text")} as w, string_split(text, chr(10)) as l
  from documents where text is not null),
cut as (
  select doc_id, text, w, line, {normal("l[line]")} as own
  from (select *, unnest(range(1, len(l) + 1)) as line from texts)),
units as (
  select doc_id, text, own, len(own) as n,
         coalesce(sum(len(own)) over (partition by doc_id, text order by line
                                      rows between unbounded preceding and 1 preceding), 0) as start
  from cut
  union all select doc_id, text, w, len(w), 0 from texts),
near_units as (
  select u.doc_id, u.text, u.start, u.n, k.template,
         2.0 * len(list_intersect(u.pairs, k.pairs)) / (len(u.pairs) + len(k.pairs)) as dice
  from (select *, {pairs("own")} as pairs from units where n >= 2 and n <= (select words from longest)) u
  join known k on len(u.pairs) between len(k.pairs) * 0.6 and len(k.pairs) * 1.6),
best_units as (
  select doc_id, text, start, n, template, dice from near_units where dice >= 0.8
  qualify row_number() over (partition by doc_id, text, start, n order by dice desc, template) = 1),
may as (
  select t.doc_id, t.text, t.w, k.*
  from (select *, {pairs("w")} as every from texts where len(w) >= 2) t join known k
    on len(t.w) >= k.size and len(list_intersect(t.every, k.pairs)) >= len(k.pairs) * 0.6),
moved as (
  select doc_id, text, template, pairs, start, size as n, w[start + 1 : start + size] as own
  from (select *, unnest(range(0, len(w) - size + 1)) as start from may)),
windows as (
  select doc_id, text, start, n, template,
         2.0 * len(list_intersect(own_pairs, pairs)) / (len(own_pairs) + len(pairs)) as dice
  from (select *, {pairs("own")} as own_pairs from moved)),
spans as (
  select doc_id, text, cast(start as int) as start, cast(n as int) as n, template, dice from best_units
  union select doc_id, text, cast(start as int), cast(n as int), template, dice from windows where dice >= 0.8)
select distinct x.doc_id, regexp_replace(x.template, '#[0-9]+$', '') as license, round(x.dice, 6) as dice,
       x.start, x.n as n_words, array_to_string(t.w[x.start + 1 : x.start + x.n], ' ') as statement
from spans x join texts t on t.doc_id is not distinct from x.doc_id and t.text = x.text
where not exists (
  select 1 from spans y
  where y.doc_id is not distinct from x.doc_id and y.text = x.text
    and y.start < x.start + x.n and y.start + y.n > x.start
    and (y.dice > x.dice or (y.dice = x.dice and (
      y.start < x.start or (y.start = x.start and (
        y.n < x.n or (y.n = x.n and y.template < x.template)))))))"""


OP12_SQL = """
with rows as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as z
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, r.vec_id as other_id, a.label = r.label as same,
         cast(list_sum(list_transform(range(1, least(len(a.z), len(r.z)) + 1),
                                      lambda i: a.z[i] * r.z[i])) as bigint) as score
  from rows a join rows r on a.vec_id <> r.vec_id where a.vec_id % 50 = 0),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, p.positive_id,
       cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id) as integer) as rank,
       s.other_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
  and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
qualify rank <= 3"""

OP13_SQL = r"""
with cut as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
  from documents),
docs as (select row_number() over () as d, doc_id, t, len(t) as n from cut where len(t) > 0),
whole as (select count(*) as cn, cast(sum(n) as bigint) as cl from docs),
held as (
  select d, term, count(*) as tf from (select d, unnest(t) as term from docs) group by d, term),
wanted as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
  group by item_id, term),
weights as (
  select term, cast(floor(1000 * ln(cast(2 * cn + 2 as double) / cast(2 * df + 1 as double))) as bigint) as w
  from (select term, count(*) as df from held group by term), whole),
parts as (
  select h.d, h.term, g.w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (25 + (75 * o.n * cn) // cl))) as s
  from held h join weights g using (term) join docs o using (d), whole
  where h.term in (select term from wanted)),
scores as (
  select q.item_id, p.d, cast(sum(q.times * p.s) as bigint) as score
  from wanted q join parts p using (term) group by q.item_id, p.d)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank,
       doc_id, score
from scores join docs using (d) where score > 0 qualify rank <= 10"""

ORACLES = {
    "op2_line_dedup": _op2_sql(),
    "op9_licenses": _op9_sql(),
    "op12_hard_negatives": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}
