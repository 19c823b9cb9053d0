"""Quality rules by tokeniser fertility.

A public vocabulary fits text of the languages it was made from: there a token
holds several characters, hardly any character falls back to bytes, and the
tokens are varied. Noise breaks one of these. Each text's words are encoded by a
public sentencepiece vocabulary; three measures are held against the bands of
the text's language (its script where the language is missing): characters per
token, share of byte-fallback tokens, and token entropy (as a share of the most
that so many tokens can have). The bands come from the quartiles of each measure
over the whole corpus, by language and length; the fewer documents a group has, the nearer
its limits are to those of the language, and these to the script's fixed band, which
every document must keep to besides. Plain counts of words,
symbols, repeated lines and repeated windows come from the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage
from .vocab import ChunkTable, runs

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5


@dataclass(frozen=True)
class Band:
    """What a script's texts keep to. Entropy is judged from min_tokens on."""

    min_chars_per_token: float
    max_chars_per_token: float
    max_byte_share: float
    min_entropy_share: float
    min_tokens: int = 40


#: First code points of runs of scripts, and the script of each run (fixed values from the Unicode block list).
_BLOCKS = ((0x0000, "other"), (0x0041, "latin"), (0x005B, "other"), (0x0061, "latin"), (0x007B, "other"), (0x00C0, "latin"),
           (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "other"), (0x0590, "hebrew"), (0x0600, "arabic"),
           (0x0780, "other"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
           (0x2000, "other"), (0x3040, "cjk"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0x20000, "cjk"), (0x32000, "other"))
_STARTS = np.array([b[0] for b in _BLOCKS])
_NAMES = sorted({b[1] for b in _BLOCKS})
_CODE = np.array([_NAMES.index(b[1]) for b in _BLOCKS])

#: Scripts that the vocabulary covers badly fall back to bytes by nature.
BANDS = {"latin": Band(1.1, 12.0, 0.10, 0.42), "cyrillic": Band(1.0, 12.0, 0.10, 0.42), "greek": Band(0.7, 8.0, 0.50, 0.35),
         "hebrew": Band(0.6, 8.0, 0.60, 0.30), "arabic": Band(0.6, 8.0, 0.60, 0.30), "indic": Band(0.3, 8.0, 1.00, 0.20),
         "thai": Band(0.3, 8.0, 1.00, 0.20), "cjk": Band(0.3, 4.0, 0.90, 0.30), "hangul": Band(0.3, 4.0, 0.95, 0.20),
         "other": Band(0.8, 12.0, 0.60, 0.30)}

#: A language's band reaches so many interquartile ranges beyond its quartiles, and at least so far in the measure's own unit.
#: Set on the labels of sf0.1 so that clean documents stay.
MARGINS = {"chars_per_token": (2.5, 0.05), "byte_share": (2.5, 0.02), "entropy_share": (2.0, 0.02)}
#: Documents for which a group's wider limits count (n of its own weigh n / (n + SHRINK)), fewest tokens of a document that the
#: bands judge, and the length below which a few numbers or names move a clean text, so that the margin is doubled.
SHRINK, MIN_TOKENS, SHORT_TOKENS = 25, 40, 256


def script_of(text: str) -> str:
    """The script of most letters; ties go to the first name."""
    try:
        text.encode("latin-1")
        return "latin" if any(c.isalpha() for c in text) else "other"
    except UnicodeEncodeError:
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        counts = np.bincount(_CODE[np.searchsorted(_STARTS, points, "right") - 1], minlength=len(_NAMES))
        counts[_NAMES.index("other")] = 0
        return _NAMES[int(counts.argmax())] if counts.any() else "other"


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of so many words that occur twice or more, the first occurrence included."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key = np.zeros(n, np.uint64)
    for k in range(window):
        key = (key ^ ids[k:k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(window):
        covered[k:k + n] |= twice
    return int(covered.sum())


@lru_cache(maxsize=2)
def _pieces(model: str) -> tuple[ChunkTable, np.ndarray]:
    """Words (as UTF-8) to piece ids, and which pieces are bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    table = ChunkTable(lambda words: runs(words, sp.encode([w.decode() for w in words], num_threads=1)))
    return table, np.array([sp.is_byte(i) for i in range(sp.vocab_size())])


def quality_measures(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text",
                     bands: dict[str, Band] = BANDS, keep: list[str] | None = None, lang: str = "lang") -> DataFrame:
    """One row per row of docs: the keep columns (default: doc_id), n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, script,
    n_tokens, chars_per_token, byte_share, entropy_share, reasons (array) and kept.

    Words are runs without ASCII white space. A null text has no words and so
    fails, as any text of fewer than ten words does; measures that such a text hasn't are 0.
    The measures are staged, as the bands come from all rows. Rows of equal text
    and language get equal results; no rows give none. Without a lang column, or
    where lang is null or empty, the script stands for the language."""
    names = keep if keep is not None else [doc_id]
    out = _judged(docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)], _said(docs, lang), docs[text].alias("_text")), model, "_text", bands)
    return out.drop("_lang", "_text").toDF(*names, *_OWN_NAMES, "kept")


_OWN = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, script string, "
           "n_tokens bigint, chars_per_token double, byte_share double, entropy_share double, reasons array<string>")
_OWN_NAMES = [x.split()[0] for x in _OWN.split(", ")]


def _said(docs: DataFrame, lang: str):
    return (F.nullif(docs[lang].cast("string"), F.lit("")) if lang in docs.columns else F.lit(None).cast("string")).alias("_lang")


def _judged(docs: DataFrame, model: str, text: str, bands: dict[str, Band]) -> DataFrame:
    """docs (with _lang) without _text, and the measures, reasons and kept."""
    def judge(data: bytes, text: str, slots: np.ndarray, table: ChunkTable, is_byte: np.ndarray, spaces: int) -> tuple:
        n_words, word_chars = len(slots), len(text) - spaces
        lines = [x for x in data.split(b"\n") if x.strip()]
        repeats = repeated_words(slots)
        base = n_words < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n_words
        ids = table.ids(slots)
        n, script = len(ids), script_of(text)
        band, reasons = bands[script], []
        fertility = word_chars / n if n else 0.0
        byte_share = float(is_byte[ids].mean()) if n else 0.0
        entropy = 0.0
        if n > 1:
            p = np.unique(ids, return_counts=True)[1] / n
            entropy = float(-(p * np.log2(p)).sum() / np.log2(min(n, len(is_byte))))
        if n and not band.min_chars_per_token <= fertility <= band.max_chars_per_token:
            reasons.append("chars_per_token")
        if byte_share > band.max_byte_share:
            reasons.append("byte_share")
        if n >= band.min_tokens and entropy < band.min_entropy_share:
            reasons.append("entropy")
        return (n_words, word_chars, sum(map(data.count, SYMBOLS)) if data else 0, len(lines) - len(set(lines)), repeats, base, script,
                n, fertility, byte_share, entropy, reasons)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, is_byte = _pieces(model)
        types = [pa.int64()] * 5 + [pa.bool_(), pa.string(), pa.int64()] + [pa.float64()] * 3 + [pa.list_(pa.string())]
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            datas = [t.encode() for t in texts]
            words = [d.split() for d in datas]   # bytes split at ASCII white space only
            slots, ends = table.slots(words), np.cumsum([0, *map(len, words)])
            rows = [judge(d, t, slots[a:b], table, is_byte, len(d) - sum(map(len, w)))
                    for d, t, w, a, b in zip(datas, texts, words, ends, ends[1:])]
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(list(c), k) for c, k in zip(columns, types))], names=[*names, *_OWN_NAMES])

    names = [c for c in docs.columns if c != "_text"]
    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in names]
    return _held_to_corpus(stage(docs.mapInArrow(run, ", ".join([*kinds, _OWN])), "fertility")).select(*names, *_OWN_NAMES, "kept")


def corpus_bands(measured: DataFrame, group: list[str]) -> DataFrame:
    """For each group its number of documents that pass the base rules, and the lower and
    upper quartile of each measure; staged, as small as the groups are few."""
    quartiles = [F.expr(f"percentile(round({m}, 3), array(0.25, 0.75))").alias(f"_{m}") for m in MARGINS]   # rounded, so that a group's state is bounded
    found = measured.where(f"not base_failed and n_tokens >= {MIN_TOKENS}").groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), *quartiles)
    return stage(found, "fertility_bands")


def _fixed(measure: str, high: bool):
    """The limit of the script's fixed band."""
    value = {("chars_per_token", False): lambda b: b.min_chars_per_token, ("chars_per_token", True): lambda b: b.max_chars_per_token,
             ("byte_share", True): lambda b: b.max_byte_share, ("entropy_share", False): lambda b: b.min_entropy_share}[measure, high]
    return F.create_map(*[F.lit(x) for name, band in BANDS.items() for x in (name, value(band))])[F.col("script")]


def _held_to_corpus(measured: DataFrame) -> DataFrame:
    """measured with the reasons of the corpus's own bands added, and kept. The limits come
    from a language's texts of like length (by powers of two), drawn to those of the whole
    language, and these to the script's fixed ones, the more the fewer the documents."""
    measured = measured.withColumn("_group", F.coalesce(F.concat(F.lit("lang "), "_lang"), F.concat(F.lit("script "), "script"))) \
        .withColumn("_length", F.length(F.bin("n_tokens")))
    near, whole = corpus_bands(measured, ["_group", "_length"]), corpus_bands(measured, ["_group"])
    both = measured.join(near, ["_group", "_length"], "left") \
        .join(whole.toDF("_group", *[f"_whole{c}" for c in whole.columns[1:]]), "_group", "left")
    wide = F.when(F.col("n_tokens") < SHORT_TOKENS, 2.0).otherwise(1.0)

    def limit(m: str, high: bool):
        out = _fixed(m, high)
        for n, quartile in ((F.col("_whole_n"), F.col(f"_whole_{m}")), (F.col("_n"), F.col(f"_{m}"))):
            times, least = MARGINS[m]
            margin = wide * F.greatest(F.lit(times) * (quartile[1] - quartile[0]), F.lit(least))
            own = quartile[1] + margin if high else quartile[0] - margin
            out = F.when(n.isNull(), out).otherwise((n * own + SHRINK * out) / (n + SHRINK))
        return out

    outside = {"chars_per_token": (F.col("chars_per_token") < limit("chars_per_token", False)) | (F.col("chars_per_token") > limit("chars_per_token", True)),
               "byte_share": F.col("byte_share") > limit("byte_share", True), "entropy": F.col("entropy_share") < limit("entropy_share", False)}
    more = [F.when(hit & (F.col("n_tokens") >= MIN_TOKENS), F.lit(reason)) for reason, hit in outside.items()]
    reasons = F.array_distinct(F.concat("reasons", F.array_compact(F.array(*more))))
    return both.withColumn("reasons", reasons).withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0))


def drop_rejected(docs: DataFrame, model: str) -> DataFrame:
    """docs without the rows that the rules reject, all columns as they were, whatever
    their names. The documents are staged with their measures once, and filtered by the few rows of bands."""
    names = docs.columns
    rows = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)], _said(docs, "lang"))
    judged = _judged(rows, model, f"c{names.index('text')}", BANDS)
    return judged.where("kept").select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
