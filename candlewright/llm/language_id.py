"""Language identification by Bayesian fusion of four kinds of evidence.

- Text: hashed trigrams of letters, log likelihood under each language, tempered so that a long page
  does not count as thousands of independent observations.
- Markup: the language a page declares.
- Address: a language code in the path or the country suffix of the host.
- Host prior: what the other pages of the host are, smoothed towards its domain, the domain towards
  its suffix, and that towards the whole corpus. All are grouped aggregations of the text's own
  posterior; a page's own share is taken out of its host's counts.

How often a page in a language declares a code or carries it in its address is estimated from all
pages, weighted by the text's posterior. Both have a bounded number of values (two or three letters).

Edge cases: a null or empty page has no text evidence, missing markup and addresses none of theirs;
what is missing is left out of the sum, and a page without any evidence gets the corpus prior. Pages and
addresses may be of any length and need not be well formed: every pattern takes time in proportion. Ties
go to the language that sorts first. Repeated rows count as often as they occur. With no labelled
texts there are no languages, and every page gets null.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from candlewright.llm import blocks
from candlewright.llm.tokens import BLANK, LOWER, mix, parts, text_bytes
from candlewright.session import materialize


@dataclass(frozen=True)
class LanguageParams:
    #: Cells of the trigram table; a power of two.
    cells: int = 1 << 15
    smoothing: float = 0.5
    #: A text counts as at most so many independent trigrams.
    weight: float = 40.0
    #: How many pages the level above is worth in a host's prior.
    host_belief: float = 5.0
    #: How many observations the overall share of a code is worth.
    code_belief: float = 5.0


_PLAIN = LOWER.copy()
_PLAIN[BLANK] = 32
_PLAIN[[b for b in range(33, 127) if not chr(b).isalpha()]] = 32


def _trigrams(data: np.ndarray, offsets: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all byte trigrams with a letter inside texts, and where each text's begin."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    x = _PLAIN[data].astype(np.uint64)
    gram = (x[:-2] << np.uint64(16)) | (x[1:-1] << np.uint64(8)) | x[2:]
    inside = np.ones(len(gram), bool)
    for back in (1, 2):
        at = offsets[1:] - back
        inside[at[(at >= 0) & (at < len(gram))]] = False
    letters = (x[:-2] != 32).astype(np.int8) + (x[1:-1] != 32) + (x[2:] != 32)
    inside &= letters >= 2
    where = np.flatnonzero(inside)
    cell = (mix(gram[where]) & np.uint64(cells - 1)).astype(np.int64)
    return cell, np.searchsorted(where, offsets)


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    #: Log probability of each cell, one column per language.
    table: np.ndarray


def fit_text(texts: DataFrame, params: LanguageParams = LanguageParams(), text: str = "text", lang: str = "lang") -> TextModel:
    """Trigram counts per language over all labelled texts."""
    cells = params.cells

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for first, last, data, offsets in parts(batch.column(1)):
                cell, starts = _trigrams(data, offsets, cells)
                langs, which = np.unique(
                    np.array(batch.column(0).slice(first, last - first).to_pylist(), object).astype(str),
                    return_inverse=True,
                )
                owner = np.repeat(which, np.diff(starts))
                for k, name in enumerate(langs):
                    add = np.bincount(cell[owner == k], minlength=cells)
                    counts[name] = counts.get(name, 0) + add
        for name, values in counts.items():
            for block, data in blocks.split(values.astype(np.int64)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([block], pa.int32()), pa.array([data], pa.binary())],
                    ["name", "block", "data"],
                )

    rows = texts.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), text_bytes(text).alias("text"))
    counted = materialize(rows.mapInArrow(scan, "name string, block int, data binary"), "trigrams")
    found = blocks.gathered(blocks.summed(counted, "int64"), cells)
    names = tuple(sorted(found))
    if not names:
        return TextModel((), np.zeros((cells, 0), np.float32))
    smooth = np.stack([found[x] for x in names], 1) + params.smoothing
    return TextModel(names, np.log(smooth / smooth.sum(0)).astype(np.float32))


_OPEN = re.compile(r"<!--|<(script|style|nav|footer)\b", re.I)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "nav", "footer")}
_CLOSE["!--"] = re.compile("-->")
_TAG = re.compile(r"<[^<>]*>")


def page_text(source: str) -> str:
    """What a reader of a page sees, roughly.

    One pass: an end that is missing once is not looked for again, so no page takes longer than its
    length allows.
    """
    out, at, start, missing = [], 0, 0, set()
    while found := _OPEN.search(source, start):
        name = (found[1] or "!--").lower()
        end = None if name in missing else _CLOSE[name].search(source, found.end())
        if end:
            out.append(source[at : found.start()])
            at = start = end.end()
        else:
            missing.add(name)
            start = found.end()
    out.append(source[at:])
    return html.unescape(_TAG.sub(" ", " ".join(out)))


def declared(source: Column) -> Column:
    """The language code a page declares: on its root element, or in a meta element.

    Elements are cut out first, by a pattern that never reads a character twice.
    """
    elements = F.regexp_extract_all(source, F.lit(r"(?i)<(?:html|meta)\b[^<>]*+>"), F.lit(0))
    code = lambda x, name: F.lower(
        F.regexp_extract(x, rf"(?i)\b{name}\s*+=\s*+[\"']?([a-z]{{2,3}})\b", 1)
    )
    root = F.filter(elements, lambda x: x.rlike(r"(?i)^<html"))
    meta = F.filter(elements, lambda x: x.rlike(r"(?i)^<meta") & x.rlike("(?i)content-language"))
    codes = F.concat(F.transform(root, lambda x: code(x, "lang")), F.transform(meta, lambda x: code(x, "content")))
    return F.get(F.filter(codes, lambda x: x != ""), F.lit(0))


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^(?i:[a-z][a-z0-9+.\-]*+://)?(?:[^/?#@]*+@)?([^/?#:@]++)", 1))
    return F.when(host != "", host)


def address_code(url: Column) -> Column:
    """A two-letter code that stands alone in the path, or the host's country suffix."""
    path = F.regexp_extract(url, r"^(?:[^/?#]*//)?[^/?#]*(/[^?#]*)", 1)
    segment = F.get(F.filter(F.split(path, "/"), lambda x: x.rlike("^[a-zA-Z]{2}$")), F.lit(0))
    suffix = F.substring_index(host_of(url), ".", -1)
    own = host_of(url).contains(".") & suffix.rlike("^[a-z]{2}$")
    return F.when(segment.isNotNull(), F.concat(F.lit("/"), F.lower(segment))).when(own, F.concat(F.lit("."), suffix))


def text_evidence(rows: DataFrame, model: TextModel, params: LanguageParams = LanguageParams()) -> DataFrame:
    """`key, host, markup, code, evidence` from `key, body, is_page, host, markup, code`.

    `evidence` is the tempered log likelihood per language, empty for a text without trigrams.
    """
    held = rows.sparkSession.sparkContext.broadcast(model)
    cells, weight = params.cells, params.weight

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value.table
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                run = batch.slice(k, 512)
                seen = [
                    (page_text(t) if page else t).encode("utf-8", "replace")
                    for t, page in zip(run.column(1).to_pylist(), run.column(2).to_pylist(), strict=True)
                ]
                out = []
                for _, _, data, offsets in parts(pa.array(seen, pa.binary())):
                    cell, starts = _trigrams(data, offsets, cells)
                    logs = table[cell]
                    for low, high in zip(starts[:-1], starts[1:], strict=True):
                        n = int(high - low)
                        mean = logs[low:high].mean(0, dtype=np.float64) if n else np.zeros(0)
                        out.append((mean * (n * weight / (n + weight))).tolist())
                yield pa.RecordBatch.from_arrays(
                    [run.column(0), *[run.column(c) for c in (3, 4, 5)], pa.array(out, pa.list_(pa.float64()))],
                    ["key", "host", "markup", "code", "evidence"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.select(
        "key", F.coalesce("body", F.lit("")).alias("body"), "is_page", "host", "markup", "code"
    ).mapInArrow(scan, f"key {kind}, host string, markup string, code string, evidence array<double>")


def _softmax(logs: Column) -> Column:
    """Probabilities from logs; every reference to `logs` is to a column that is already computed."""
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def _log_shares(seen: DataFrame, column: str, n: int, belief: float) -> dict[str, list[float]]:
    """log P(code | language) relative to the code's overall share; at most 27 ** 3 codes."""
    found = (
        seen.where(F.col(column).isNotNull() & (F.size("p") > 0))
        .groupBy(column)
        .agg(*[F.sum(F.get("p", F.lit(k))).alias(f"s{k}") for k in range(n)])
        .collect()
    )
    counts = {row[0]: np.array([row[f"s{k}"] for k in range(n)]) for row in found}
    if not counts:
        return {}
    totals = sum(counts.values())
    share = {c: v.sum() / totals.sum() for c, v in counts.items()}
    return {
        c: np.log((v + belief * share[c]) / (totals + belief) / share[c]).tolist() for c, v in counts.items()
    }


def _host_priors(seen: DataFrame, n: int, belief: float) -> tuple[DataFrame, list[float]]:
    """Per host: its summed posteriors and its domain's smoothed shares; and the corpus shares."""
    sums = [F.sum(f"s{k}").alias(f"s{k}") for k in range(n)]
    by_host = (
        seen.where((F.size("p") > 0) & F.col("host").isNotNull())
        .groupBy("host")
        .agg(*[F.sum(F.get("p", F.lit(k))).alias(f"s{k}") for k in range(n)])
        .withColumn("domain", F.substring_index("host", ".", -2))
        .withColumn("suffix", F.substring_index("host", ".", -1))
    )
    by_host = materialize(by_host, "hosts")
    everything = by_host.agg(*sums).first()
    counts = [(everything[f"s{k}"] or 0.0) + 1.0 for k in range(n)]
    corpus = [c / sum(counts) for c in counts]

    def shares(table: DataFrame, key: str, above: list[Column]) -> DataFrame:
        total = sum((F.col(f"s{k}") for k in range(n)), F.lit(0.0)) + belief
        named = F.array(*[(F.col(f"s{k}") + belief * above[k]) / total for k in range(n)])
        return table.select(key, named.alias(f"{key}_share"))

    by_domain = by_host.groupBy("domain").agg(*sums, F.min("suffix").alias("suffix"))
    by_suffix = by_host.groupBy("suffix").agg(*sums)
    suffixes = shares(by_suffix, "suffix", [F.lit(x) for x in corpus])
    domains = by_domain.join(suffixes, "suffix")
    domains = shares(domains, "domain", [F.get("suffix_share", F.lit(k)) for k in range(n)])
    hosts = by_host.join(domains, "domain").select(
        F.col("host").alias("at_host"), F.array(*[F.col(f"s{k}") for k in range(n)]).alias("host_sums"), "domain_share"
    )
    return materialize(hosts, "host-priors"), corpus


def identify(rows: DataFrame, model: TextModel, params: LanguageParams = LanguageParams()) -> DataFrame:
    """`key, language, probability, text_language, prior` for rows `key, body, is_page, host, markup, code`."""
    n = len(model.languages)
    if not n:
        return rows.select(
            "key",
            F.lit(None).cast("string").alias("language"),
            F.lit(None).cast("double").alias("probability"),
            F.lit(None).cast("string").alias("text_language"),
            F.lit(None).cast("array<double>").alias("prior"),
        )
    seen = materialize(text_evidence(rows, model, params), "evidence")
    seen = seen.withColumn("p", _softmax(F.col("evidence")))
    markup = _log_shares(seen, "markup", n, params.code_belief)
    codes = _log_shares(seen, "code", n, params.code_belief)
    hosts, corpus = _host_priors(seen, n, params.host_belief)

    def from_codes(df: DataFrame, column: str, table: dict[str, list[float]]) -> DataFrame:
        """Adds the codes' log shares; a table of at most 27 ** 3 rows."""
        known = df.sparkSession.createDataFrame(list(table.items()), f"of_{column} string, {column}_logs array<double>")
        return df.join(F.broadcast(known), F.col(column) == F.col(f"of_{column}"), "left")

    def own(k: int) -> Column:
        return F.when(F.size("p") > 0, F.get("p", F.lit(k))).otherwise(0.0)

    at = [F.lit(k) for k in range(n)]
    seen = from_codes(from_codes(seen, "markup", markup), "code", codes)
    joined = seen.join(hosts, F.col("host") == F.col("at_host"), "left")
    total = F.aggregate("host_sums", F.lit(0.0), lambda a, b: a + b)
    mass = sum((own(k) for k in range(n)), F.lit(0.0))
    prior = [
        F.when(
            F.col("host_sums").isNotNull(),
            (F.greatest(F.get("host_sums", at[k]) - own(k), F.lit(0.0)) + params.host_belief * F.get("domain_share", at[k]))
            / (F.greatest(total - mass, F.lit(0.0)) + params.host_belief),
        ).otherwise(corpus[k])
        for k in range(n)
    ]
    joined = joined.withColumn("prior", F.array(*prior))
    logs = [
        F.log(F.get("prior", at[k]))
        + F.when(F.size("evidence") > 0, F.get("evidence", at[k])).otherwise(0.0)
        + F.coalesce(F.get("markup_logs", at[k]), F.lit(0.0))
        + F.coalesce(F.get("code_logs", at[k]), F.lit(0.0))
        for k in range(n)
    ]
    names = F.array(*[F.lit(x) for x in model.languages])
    best = lambda c: F.get(names, (F.array_position(c, F.array_max(c)) - 1).cast("int"))
    return (
        joined.withColumn("logs", F.array(*logs))
        .withColumn("posterior", _softmax(F.col("logs")))
        .select(
            "key",
            best(F.col("posterior")).alias("language"),
            F.array_max("posterior").alias("probability"),
            F.when(F.size("p") > 0, best(F.col("p"))).alias("text_language"),
            "prior",
        )
    )
