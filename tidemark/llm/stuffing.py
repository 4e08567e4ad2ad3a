"""Pages of repeated keywords, link lists and tag lists instead of sentences.

A text is cut into even blocks of at most ``block`` signs and each block is measured:

- ``bag``: the compressed size of its words in sorted order. Sorting takes away the order, so that keywords shuffled again and again compress as far as keywords repeated in order.
- ``bones``: the compressed size of its skeleton, in which every link and every word that isn't common in the language is one sign. Lists of ever new links, tags or names look
  varied as text, but their skeleton is the same few signs; digits stay as they are, so that log lines and tables of numbers keep what they say.
- ``ends``: the sentence-ending marks, outside links.
- ``digits``, outside links: where they are ``numbers`` of the signs, a block is a record of data (a log, a table), which is redundant for other reasons.

Which words are common is counted over the whole corpus, language by language; there is no word list, and a language too rare to be counted has none: its words all stay in the skeleton.
Both sizes are set against what blocks of prose need at that length, in that language and script, which are medians over all blocks of the corpus that have sentence ends;
a language or script with too few blocks falls back on the script, then on a fixed line. A block is stuffed if

- its bag is ``extreme``, whatever its punctuation; or
- its bag is ``redundant`` and sentence ends are far denser than in the language's prose, as where keywords are dressed up as sentences; or
- sentence ends are nearly missing, it is no record, and its bag is ``redundant`` or its skeleton ``listed``.

A page is found if more than ``share`` of its signs lie in stuffed blocks.

Defined cases: null, empty and blank texts are never found; a null language is a language of its own; repeated rows are judged alike and each is returned; texts of any length are judged, and read
whole; the other columns of the table stay out of the way, whatever their names; an empty table gives an empty result.

Scale: common words are a map-side aggregate over (language, word); one narrow pass in Arrow batches gives a few numbers per block, and texts go no further. To the driver come
at most ``words`` words of each language that has at least one document in ``rare`` (so at most ``rare`` languages), one median per length class and at most 47 rows of scripts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.runtime import materialise

_LINK = re.compile(r"<a\b[^>]*>.*?</a>|\[[^\]\n]*\]\([^)\s]*\)|(?:https?://|www\.)\S+", re.S | re.I)
_WORD = re.compile(r"\w+")
_RUN = re.compile(r"[^\W\d_]+|[\W\d_]+")
_DIGITS = re.compile(r"\d+")
_END = re.compile(r"[.!?…](?=[\"'”»)\]]*(?:\s|$))|[。！？؟।]")
_HEADER = 8  # bytes that any compressed block has
_OTHER = 0x2E  # scripts from here on count as one


@dataclass(frozen=True)
class StuffingLimits:
    block: int = 1000
    share: float = 0.5  # of a page's signs
    extreme: float = 0.2  # of the usual size
    redundant: float = 0.68
    listed: float = 0.72
    few_ends: float = 0.3  # of the usual density of sentence ends
    many_ends: float = 1.4
    numbers: float = 0.17  # of a block's signs
    prose_span: int = 120  # signs for one sentence end in what counts as prose
    common: float = 0.1  # of a language's documents
    words: int = 500  # common words of a language
    rare: int = 2000
    least: int = 30  # documents or blocks behind a figure


def _size(data: str) -> int:
    return max(len(zlib.compress(data.encode(errors="replace"), 1)) - _HEADER, 1)


def script_of(text: str) -> int:
    """The 256-sign page of the median letter's code point: 0 for Latin, 4 for Cyrillic and so on."""
    if text.isascii():
        return 0
    points = np.frombuffer(text.encode("utf-32-le", errors="replace"), np.uint32)
    points = points[points > 64]
    page = int(np.median(points)) >> 8 if len(points) else 0
    return 0 if page <= 2 else min(page, _OTHER)


class Skeletons(dict):
    """What stands for a run of letters or of other signs in the skeleton: itself where it is common or no word, else one sign. Runs are kept once met, up to KEPT of them."""

    KEPT = 200_000

    def __init__(self, common: frozenset[str]):
        super().__init__()
        self.common = common

    def __missing__(self, run: str) -> str:
        if len(self) >= self.KEPT:
            self.clear()
        out = self[run] = "x" if run[0].isalpha() and run.lower() not in self.common else run
        return out

    def of(self, text: str) -> str:
        return "".join(map(self.__getitem__, _RUN.findall(text)))


def measure(text: str | None, skeletons: Skeletons | None, limits: StuffingLimits) -> list[tuple[int, int, int, int, int | None]]:
    """(chars, ends, digits, bag, bones) of each block. Where there are sentence ends enough for prose neither digits nor the skeleton matter: 0 and null."""
    if text is None or not text.strip():
        return []
    step, out = -(-len(text) // -(-len(text) // limits.block)), []
    for i in range(0, len(text), step):
        block = text[i : i + step]
        low = block.lower()
        plain = _LINK.sub("\x01", block) if "//" in block or "www." in low or "](" in block or "<a" in low else block
        ends = len(_END.findall(plain))
        digits, bones = 0, None
        if ends * limits.prose_span < len(block):
            digits, bones = sum(map(len, _DIGITS.findall(plain))), _size(plain if skeletons is None else skeletons.of(plain))
        out.append((len(block), ends, digits, _size(" ".join(sorted(_WORD.findall(low)))), bones))
    return out


def common_words(docs: DataFrame, text: str, lang: str, limits: StuffingLimits) -> dict[str, frozenset[str]]:
    """The words that at least ``common`` of a language's documents hold, for each language that isn't rare."""
    rows = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.col(text).alias("text")).filter("text is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    held = rows.select("lang", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word")).filter("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("k"))
    known = sizes.filter((F.col("n") >= limits.least) & (F.col("n") * limits.rare >= total))
    usual = held.join(known, "lang").filter(F.col("k") >= F.col("n") * limits.common)
    top = Window.partitionBy("lang").orderBy(F.desc("k"), "word")
    found = usual.withColumn("_at", F.row_number().over(top)).filter(F.col("_at") <= limits.words).groupBy("lang").agg(F.collect_list("word").alias("words")).collect()
    return {r["lang"]: frozenset(r["words"]) for r in found}


_BLOCK = T.StructType([T.StructField(n, T.IntegerType()) for n in ("chars", "ends", "digits", "bag", "bones")])


def measures(docs: DataFrame, *, key: str, text: str, lang: str, limits: StuffingLimits) -> DataFrame:
    """(key, lang, script, blocks) of each row."""
    words = docs.sparkSession.sparkContext.broadcast(common_words(docs, text, lang, limits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {x: Skeletons(w) for x, w in words.value.items()}
        for b in batches:
            texts, langs = b.column(2).to_pylist(), b.column(1).to_pylist()
            found = [measure(t, known.get(x), limits) for t, x in zip(texts, langs, strict=True)]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)]).astype(np.int32)
            figures = list(zip(*chain.from_iterable(found), strict=True)) or [()] * len(_BLOCK)
            blocks = pa.StructArray.from_arrays([pa.array(f, pa.int32()) for f in figures], names=_BLOCK.names)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([script_of(t or "") for t in texts], pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), blocks)], names=["key", "lang", "script", "blocks"])

    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("lang", T.StringType()), T.StructField("script", T.IntegerType()), T.StructField("blocks", T.ArrayType(_BLOCK))])
    return docs.select(key, F.coalesce(F.col(lang), F.lit("")), text).mapInArrow(run, schema)


def _bits(chars: Column) -> Column:
    """The length class of a block: how many binary digits its length has."""
    return (F.floor(F.log2(F.greatest(chars, F.lit(1)))) + 1).cast("int")


def _by(values: dict, key: Column) -> Column:
    return F.create_map(*(x for k, v in values.items() for x in (F.lit(k), F.lit(float(v)))))[key] if values else F.lit(None).cast("double")


def with_usual(found: DataFrame, limits: StuffingLimits) -> DataFrame:
    """``found`` with ``factor``, what a language and script need relative to the usual at any length, ``density`` of its sentence ends, and ``by_length``, the usual by length class."""
    blocks = found.select("lang", "script", F.explode("blocks").alias("b")).select("lang", "script", "b.*").filter(F.col("ends") * limits.prose_span >= F.col("chars"))
    ratio = F.col("bag") / F.col("chars")
    median = lambda c: F.percentile_approx(c, 0.5, 10_000)
    enough = F.col("n") >= limits.least
    lengths = {r["bits"]: r["usual"] for r in blocks.groupBy(_bits(F.col("chars")).alias("bits")).agg(median(ratio).alias("usual"), F.count("*").alias("n")).filter(enough).collect()}
    line = lambda bits: F.lit(1.2) - F.lit(0.075) * bits  # noqa: E731 - what prose needs where the corpus is too small to tell
    usual = lambda chars: F.coalesce(_by(lengths, _bits(chars)), line(_bits(chars)))
    figures = [median(ratio / usual(F.col("chars"))).alias("factor"), median(F.col("ends") / F.col("chars")).alias("density"), F.count("*").alias("n")]
    scripts = {r["script"]: r for r in blocks.groupBy("script").agg(*figures).filter(enough).collect()}  # at most 47 rows
    fine = blocks.groupBy("lang", "script").agg(*figures).filter(enough).drop("n")
    rough = lambda c: _by({k: r[c] for k, r in scripts.items()}, F.col("script"))
    both = found.join(fine, ["lang", "script"], "left")
    return both.withColumns({"factor": F.coalesce("factor", rough("factor"), F.lit(1.0)), "density": F.coalesce("density", rough("density"), F.lit(1 / 75)), "blocks": F.transform("blocks", lambda b: b.withField("usual", usual(b["chars"])))})


def judged(docs: DataFrame, *, key: str, text: str, lang: str, limits: StuffingLimits = StuffingLimits()) -> DataFrame:
    """(key, stuffed_share, normalised, ends, stuffed) of each row: the share of its signs in stuffed blocks, its bag and its sentence ends relative to the usual."""
    found = with_usual(materialise(measures(docs, key=key, text=text, lang=lang, limits=limits), "stuffing"), limits)
    usual = lambda b: b["usual"] * b["chars"] * F.col("factor")
    ends = lambda b: b["ends"] / b["chars"] / F.col("density")

    def stuffed(b: Column) -> Column:
        few = ends(b) <= limits.few_ends
        bag = b["bag"] / usual(b)
        listed = F.coalesce(b["bones"] / usual(b) <= limits.listed, F.lit(False))
        record = b["digits"] >= limits.numbers * b["chars"]
        redundant = bag <= limits.redundant
        return (bag <= limits.extreme) | (redundant & (ends(b) >= limits.many_ends)) | (few & ~record & (redundant | listed))

    total = lambda what: F.aggregate("blocks", F.lit(0.0), lambda s, b: s + what(b))
    sums = found.select(
        F.col("key").alias(key), total(lambda b: b["chars"].cast("double")).alias("_chars"), total(lambda b: F.when(stuffed(b), b["chars"].cast("double")).otherwise(0.0)).alias("_stuffed"),
        total(lambda b: b["bag"].cast("double")).alias("_bag"), total(usual).alias("_usual"), (total(lambda b: b["ends"].cast("double")) / F.col("density")).alias("_ends"),
    )
    some = lambda c: F.when(F.col("_chars") > 0, c)
    share = F.coalesce(some(F.col("_stuffed") / F.col("_chars")), F.lit(0.0))
    return sums.select(key, share.alias("stuffed_share"), some(F.col("_bag") / F.col("_usual")).alias("normalised"), some(F.col("_ends") / F.col("_chars")).alias("ends"), (share > limits.share).alias("stuffed"))
