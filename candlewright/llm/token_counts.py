"""Token counts of texts: every distinct pre-token is encoded once, and documents sum up its count.

A pre-token is what no piece reaches beyond: blanks with the word behind them, or, where no piece
holds a line feed, a single line feed. Pieces never join across these borders, so the number of
tokens of a text is the sum over its pre-tokens.

1. Each task counts the pre-tokens of its texts; sums per pre-token are encoded, once each, into
   `pre_token, n, tokens`. Long ones (over 32 characters) are encoded where they are met, once per
   task, and go on under a digest, so no long string is shuffled.
2. The most frequent pre-tokens, at most 262,144 of at most 128 bytes each whatever the corpus, are
   cut off by a histogram of frequencies. This head is joined to the frequencies of every document
   from a broadcast, in the pass that takes the frequencies.
3. The other pre-tokens of a document are rows `row, pre_token, m`, joined by pre-token with the
   counts. None is as frequent as one of the head, so no task gets a large part of the rows.

No list of token ids is kept. Edge cases: null counts as empty, and an empty text has no tokens. The
marker character in a text is the blank it stands for, as in the library. Rows that share an id, and
rows without one, are counted each by itself. Very long texts are read in slices that end at
borders, whole. An empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from candlewright.session import materialize

MARK = "▁"
#: Pre-tokens in the head, at most.
HEAD = 1 << 18
#: Characters of a pre-token that is shuffled as it is; a longer one goes under its digest.
WIDE = 32
#: Entries a task counts before it hands them on.
HELD = 1 << 17
#: Characters of a text read at a time.
SLICE = 1 << 20


@dataclass(frozen=True)
class Model:
    """A model file's content, and whether a line feed is in no piece."""

    content: bytes
    by_line: bool


def load_model(path: str) -> Model:
    """Read a model file, on the driver; tasks get its content."""
    import sentencepiece

    with open(path, "rb") as file:
        content = file.read()
    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
        raise ValueError("the model has pieces that reach from a word over a blank")
    return Model(content, not any("\n" in p for p in pieces) and len(model.encode("\n")) == 2)


class Splitter:
    """Cuts texts into pre-tokens and counts the tokens of one."""

    def __init__(self, model: Model) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model.content)
        self.by_line = model.by_line
        end = "\n" if model.by_line else ""
        self.pattern = re.compile(rf"\n| *[^ {end}]+| +" if end else " *[^ ]+| +")
        #: Where a slice may end: before a line feed, or before the first blank of several.
        self.border = re.compile(r"\n|(?<=[^ ]) " if end else r"(?<=[^ ]) ")

    def slices(self, text: str) -> Iterator[str]:
        """The text with the blank that is put in front, in parts that end at borders."""
        text = " " + text.replace(MARK, " ")
        at = 0
        while len(text) - at > SLICE:
            found = self.border.search(text, at + SLICE)
            if not found:
                break
            yield text[at : found.start()]
            at = found.start()
        yield text[at:]

    def frequencies(self, text: str) -> Counter[str]:
        found: Counter[str] = Counter()
        if text:
            for part in self.slices(text):
                found.update(self.pattern.findall(part))
        return found

    def tokens(self, pre_tokens: list[str]) -> list[int]:
        """Tokens of each: the model puts a blank in front itself, so one is taken off."""
        inner = [p[0] != " " for p in pre_tokens]
        given = ["\n" + p if bare else p[1:] for p, bare in zip(pre_tokens, inner, strict=True)]
        found = self.model.encode(given, num_threads=1)
        # A single blank is what the model puts before a text, which alone it leaves away.
        return [
            1 if p == " " else len(ids) - 2 * bare
            for p, ids, bare in zip(pre_tokens, found, inner, strict=True)
        ]


_splitters: dict[Model, Splitter] = {}


def splitter(model: Model) -> Splitter:
    """One per Python worker and model."""
    if model not in _splitters:
        _splitters.clear()
        _splitters[model] = Splitter(model)
    return _splitters[model]


def digest(pre_token: str) -> str:
    """What a long pre-token goes under; too long to be one of the short ones."""
    return hashlib.blake2b(pre_token.encode(), digest_size=32).hexdigest()


def runs(column: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, pa.Array]]:
    """Parts of a column of texts of about so many bytes, with where each begins."""
    step = max(1, most // max(1, column.nbytes // max(1, len(column))))
    for k in range(0, len(column), step):
        yield k, column.slice(k, step)


def _texts(docs: DataFrame, text: str) -> Column:
    return F.coalesce(docs[text].cast("string"), F.lit("")).alias("text")


def pre_token_counts(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`pre_token, n, tokens`: every distinct pre-token, its occurrences and its tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splitter(shared.value)
        short: Counter[str] = Counter()
        wide: dict[str, list[int]] = {}

        def handed_on() -> pa.RecordBatch:
            keys, counts = [*short, *wide], [*short.values(), *(n for n, _ in wide.values())]
            tokens = [None] * len(short) + [t for _, t in wide.values()]
            short.clear()
            wide.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(counts, pa.int64()), pa.array(tokens, pa.int64())],
                ["pre_token", "n", "tokens"],
            )

        for batch in batches:
            for _, run in runs(batch.column(0)):
                for words in map(own.frequencies, run.to_pylist()):
                    for long in [w for w in words if len(w) > WIDE]:
                        n, key = words.pop(long), digest(long)
                        if key not in wide:
                            wide[key] = [0, own.tokens([long])[0]]
                        wide[key][0] += n
                    short.update(words)
                    if len(short) + len(wide) > HELD:
                        yield handed_on()
        yield handed_on()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splitter(shared.value)
        for batch in batches:
            keys, counts, tokens = (batch.column(k) for k in range(3))
            known = tokens.to_pylist()
            new = [k for k, t in enumerate(known) if t is None]
            for k, t in zip(new, own.tokens([keys[k].as_py() for k in new]), strict=True):
                known[k] = t
            yield pa.RecordBatch.from_arrays(
                [keys, counts, pa.array(known, pa.int64())], ["pre_token", "n", "tokens"]
            )

    schema = "pre_token string, n bigint, tokens bigint"
    parts = docs.select(_texts(docs, text)).mapInArrow(met, schema)
    sums = parts.groupBy("pre_token").agg(F.sum("n").alias("n"), F.max("tokens").alias("tokens"))
    return sums.mapInArrow(encoded, schema)


def count_tokens(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`id, n_bytes, n_tokens` for every row."""
    context = docs.sparkSession.sparkContext
    counts = materialize(pre_token_counts(docs, model, text), "pre-tokens")
    # Sixteen steps to a doubling: some hundred levels whatever the counts.
    level = F.floor(F.log2("n") * 16)
    levels = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    least, held = levels[0]["level"] + 1 if levels else 0, 0
    for row in levels:
        held += row["count"]
        if held > HEAD:
            break
        least = row["level"]
    often = level >= least
    head = {r["pre_token"]: r["tokens"] for r in counts.where(often).toLocalIterator()}
    shared, known = context.broadcast(model), context.broadcast(head)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, tokens = splitter(shared.value), known.value
        for batch in batches:
            for k, run in runs(batch.column(2)):
                sums, ends, keys, times = [], [0], [], []
                for words in map(own.frequencies, run.to_pylist()):
                    n = 0
                    for word, m in words.items():
                        if len(word) > WIDE:
                            word = digest(word)
                        t = tokens.get(word)
                        if t is None:
                            keys.append(word)
                            times.append(m)
                        else:
                            n += m * t
                    sums.append(n)
                    ends.append(len(keys))
                pairs = pa.StructArray.from_arrays(
                    [pa.array(keys, pa.string()), pa.array(times, pa.int64())], ["pre_token", "m"]
                )
                rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
                rows = [batch.column(c).slice(k, len(run)) for c in (0, 1, 3)]
                yield pa.RecordBatch.from_arrays(
                    [*rows, pa.array(sums, pa.int64()), rest], ["row", "id", "n_bytes", "n_tokens", "rest"]
                )

    body = _texts(docs, text)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        body,
        F.octet_length(body).cast("bigint").alias("n_bytes"),
    )
    kind = dict(rows.dtypes)["id"]
    partly = materialize(
        rows.mapInArrow(
            joined,
            f"row bigint, id {kind}, n_bytes bigint, n_tokens bigint, rest array<struct<pre_token string, m bigint>>",
        ),
        "frequencies",
    )
    rest = (
        partly.select("row", F.inline("rest"))
        .join(counts.where(~often).select("pre_token", "tokens"), "pre_token")
        .groupBy("row")
        .agg(F.sum(F.col("m") * F.col("tokens")).alias("more"))
    )
    return partly.join(rest, "row", "left").select(
        "id", "n_bytes", (F.col("n_tokens") + F.coalesce("more", F.lit(0))).alias("n_tokens")
    )
