"""Phrase collocations by relational set mining (SETM).

The corpus is an occurrence relation (piece, position, word), kept sorted and persisted:
a row holds one language's pieces of some megabytes of text as an array of word numbers,
with a gap (-1) after each piece, so that neighbours in the array are adjacent
positions of one piece. Each round

1. merge-joins the occurrences of frequent phrases of k words with those of single words
   at the position after them (both arrays are sorted by piece and position, so the join
   runs along them), which gives the occurrences of phrases of k + 1 words;
2. counts their groups: every row sends each distinct group once, and groups are dealt
   by hash to as many parts as the measured number of occurrences needs, so that a
   part has a bounded number of entries and a phrase of a third of all text no more than
   one entry for each row;
3. semi-joins the occurrences with the frequent groups, and persists what is left for the next round.

Words and phrases are numbered by the tables of the frequent ones; no hash stands for
a word or a phrase. Scores, subsumption and ranks are joins and windows over those tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stage

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
SUBSUMED_PERCENT = 80
SCALE = 1_000_000
NO_LANG = "und"
ROW_BYTES = 4 << 20     # text of one row of the relation
PART_KEYS = 1 << 20     # occurrences, and so entries at most, that one part counts on average
SALTS = 32

#: ASCII upper case to lower case; ends of pieces [.,;:!?\x0A-\x0D] to a byte that UTF-8 hasn't.
_GAP = 0xFF
_TABLE = bytes(_GAP if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MARK = bytes([_GAP])


def tokens(text: str) -> list[bytes]:
    """The words of a text in lower case, with the mark of a gap after each piece."""
    return text.encode().translate(_TABLE).replace(_MARK, b" " + _MARK + b" ").split() + [_MARK]


def _ints(blob: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(blob, kind)


def occurrences(docs: DataFrame, lang: str = "lang", text: str = "text", row_bytes: int = ROW_BYTES) -> DataFrame:
    """row, lang, words (distinct, by number), counts (int32), codes (int32: word numbers, -1 for a gap), n (words); staged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size, number = 0, count(TaskContext.get().partitionId() << 32)

        def flush() -> Iterator[pa.RecordBatch]:
            for name, words in sorted(held.items()):
                own = dict(zip(dict.fromkeys([_MARK, *words]), count(-1)))
                codes = np.fromiter(map(own.__getitem__, words), np.int32, len(words))
                counts = np.bincount(codes[codes >= 0], minlength=len(own) - 1).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {"row": pa.array([next(number)]), "lang": pa.array([name]), "words": pa.array([list(own)[1:]], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                     "counts": pa.array([counts.tolist()], pa.list_(pa.int32())), "codes": pa.array([codes.tobytes()], pa.binary()), "n": pa.array([int(counts.sum())])})
            held.clear()

        for batch in slices(batches, 64):
            for name, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found = tokens(t or "")
                if len(found) > 1:
                    held.setdefault(name, []).extend(found)
                    size += len(t)
                if size >= row_bytes:
                    yield from flush()
                    size = 0
        yield from flush()

    said = F.coalesce(docs[lang].cast("string"), F.lit(NO_LANG)).alias("lang") if lang in docs.columns else F.lit(NO_LANG).alias("lang")
    return stage(docs.select(said, docs[text].alias("text")).mapInArrow(run, "row bigint, lang string, words array<string>, counts array<int>, codes binary, n bigint"), "occurrences")


def frequent_words(rows: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """The words of each row (row, code, lang, word), and the frequent ones of the corpus: id, lang, word, f; staged."""
    each = rows.select("row", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select("row", "lang", F.col("pos").alias("code"), "col.words", "col.counts") \
        .withColumnsRenamed({"words": "word", "counts": "n"})
    found = each.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    return each, stage(stage(found, "words").withColumn("id", F.monotonically_increasing_id()), "frequent-words")


def _recode(codes: np.ndarray, frequent: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """codes with only the frequent ones left (else -1), numbered anew, and the ids of the new numbers."""
    new = np.full(int(max(codes.max(initial=-1), frequent.max(initial=-1))) + 2, -1, np.int32)   # the last place is that of -1
    new[frequent] = np.arange(len(frequent), dtype=np.int32)
    return new[codes], ids


def first_relation(rows: DataFrame, each: DataFrame, words: DataFrame) -> DataFrame:
    """Semi-join of the occurrences with the frequent words: row, words and ones (the ids
    of single words and their numbers by position), ids and codes (the same of the phrases so far, here words too)."""
    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        codes = [_ints(c, np.int32) for c in own["codes"].to_pylist()]
        if not codes or not found.num_rows:
            return empty
        new, ids = _recode(codes[0], found["code"].to_numpy(), found["id"].to_numpy())
        blobs = [pa.array([ids.astype(np.int64).tobytes()], pa.binary()), pa.array([new.tobytes()], pa.binary())]
        return pa.table([own["row"], *blobs, *blobs], names=["row", "words", "ones", "ids", "codes"])

    empty = pa.schema([("row", pa.int64()), *((c, pa.binary()) for c in ("words", "ones", "ids", "codes"))]).empty_table()
    known = each.select("row", "code", "lang", "word").join(words.select("lang", "word", "id"), ["lang", "word"]).select(F.col("row").alias("of"), "code", "id")
    return stage(rows.select("row", "codes").groupBy("row").cogroup(known.groupBy("of"))
                 .applyInArrow(run, "row bigint, words binary, ones binary, ids binary, codes binary"), "relation-1")


def _joined(ones: np.ndarray, codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The merge join: positions at which a frequent phrase of length words and a word right after it
    stand, if the phrase without its first word is frequent as well; the phrase's and the word's numbers."""
    if len(codes) <= length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero((codes[:-length] >= 0) & (ones[length:] >= 0) & (codes[1:len(codes) - length + 1] >= 0))
    return at, codes[at].astype(np.int64), ones[at + length].astype(np.int64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def group_counts(relation: DataFrame, length: int, parts: int) -> DataFrame:
    """part, row, a, b, cnt: the distinct groups (phrase id, word id) of each row that fall into the part, and their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            r = batch.to_pylist()[0]
            words, ids = _ints(r["words"]), _ints(r["ids"])
            _, left, right = _joined(_ints(r["ones"], np.int32), _ints(r["codes"], np.int32), length)
            key, cnt = np.unique(left * len(words) + right, return_counts=True)
            a, b = ids[key // max(len(words), 1)], words[key % max(len(words), 1)]
            part = (_mix(a, b) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            a, b, cnt, part = a[order], b[order], cnt[order].astype(np.int32), part[order]
            own, first = np.unique(part, return_index=True)
            spans = list(zip(first, [*first[1:], len(part)]))
            yield pa.RecordBatch.from_pydict({"part": pa.array(own), "row": pa.array([r["row"]] * len(own), pa.int64())} |
                                             {n: pa.array([c[x:y].tobytes() for x, y in spans], pa.binary()) for n, c in (("a", a), ("b", b), ("cnt", cnt))})

    return relation.mapInArrow(run, "part bigint, row bigint, a binary, b binary, cnt binary")


def frequent_groups(counts: DataFrame, min_count: int = MIN_COUNT, whose: bool = True) -> DataFrame:
    """row, a, b, id, f (binaries): of each part the frequent groups with their new ids and counts (row null) and, if
    whose, for each row of the relation those that it holds (f empty); staged."""
    def run(t: pa.Table) -> pa.Table:
        part, rows = t["part"][0].as_py(), t["row"].to_pylist()
        a, b, cnt = ([_ints(x, k) for x in t[c].to_pylist()] for c, k in (("a", np.int64), ("b", np.int64), ("cnt", np.int32)))
        of = np.repeat(np.arange(len(rows)), [len(x) for x in a])
        a, b, cnt = np.concatenate(a), np.concatenate(b), np.concatenate(cnt).astype(np.int64)
        order = np.lexsort((of, b, a))
        a, b, cnt, of = a[order], b[order], cnt[order], of[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        first = np.flatnonzero(new)
        total = np.add.reduceat(cnt, first)
        keep = total >= min_count
        ids = (part << 32) + np.cumsum(keep) - 1
        out = [(None, a[first[keep]], b[first[keep]], ids[keep], total[keep])]
        if whose:
            group = np.cumsum(new) - 1
            held = np.flatnonzero(keep[group])
            held = held[np.argsort(of[held], kind="stable")]
            edges = np.searchsorted(of[held], np.arange(len(rows) + 1))
            out += [(rows[i], a[h], b[h], ids[group[h]], total[:0]) for i, (x, y) in enumerate(zip(edges, edges[1:])) if x < y for h in (held[x:y],)]
        return pa.table({"row": pa.array([r[0] for r in out], pa.int64())} |
                        {n: pa.array([r[i + 1].astype(np.int64).tobytes() for r in out], pa.binary()) for i, n in enumerate(("a", "b", "id", "f"))})

    return stage(counts.groupBy("part").applyInArrow(run, "row bigint, a binary, b binary, id binary, f binary"), "frequent-groups")


def group_table(groups: DataFrame) -> DataFrame:
    """id, a, b, f: a row for each frequent group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            yield pa.RecordBatch.from_pydict({n: pa.array(_ints(batch.column(n)[0].as_py())) for n in ("id", "a", "b", "f")})

    return groups.where("row is null").select("id", "a", "b", "f").mapInArrow(run, "id bigint, a bigint, b bigint, f bigint")


def next_relation(relation: DataFrame, groups: DataFrame, length: int) -> DataFrame:
    """Semi-join of the occurrences of length + 1 words with the frequent groups; rows without any are left out. Positions that
    no frequent phrase covers become gaps, and runs of gaps one."""
    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        if not own.num_rows or not found.num_rows:
            return empty
        r = own.to_pylist()[0]
        words, ids, ones = _ints(r["words"]), _ints(r["ids"]), _ints(r["ones"], np.int32)
        at, left, right = _joined(ones, _ints(r["codes"], np.int32), length)
        a, b, new_ids = (np.concatenate([_ints(x) for x in found[c].to_pylist()]) for c in ("a", "b", "id"))
        order_ids, order_words = np.argsort(ids), np.argsort(words)
        local = order_ids[np.searchsorted(ids, a, sorter=order_ids)] * len(words) + order_words[np.searchsorted(words, b, sorter=order_words)]
        order = np.argsort(local)
        local, new_ids = local[order], new_ids[order]
        key = left * len(words) + right
        place = np.minimum(np.searchsorted(local, key), len(local) - 1)
        hit = local[place] == key
        codes = np.full(len(ones), -1, np.int32)
        codes[at[hit]] = place[hit]
        covered = np.zeros(len(ones), bool)
        for k in range(length + 1):
            covered[at[hit] + k] = True
        keep = covered | np.concatenate([[False], covered[:-1]])   # a gap after each run
        ones = np.where(covered, ones, -1)[keep].astype(np.int32)
        return pa.table([own["row"], own["words"], *(pa.array([x.tobytes()], pa.binary()) for x in (ones, new_ids, codes[keep]))],
                        names=["row", "words", "ones", "ids", "codes"])

    empty = pa.schema([("row", pa.int64()), *((c, pa.binary()) for c in ("words", "ones", "ids", "codes"))]).empty_table()
    held = groups.where("row is not null").select(F.col("row").alias("of"), "a", "b", "id")
    return stage(relation.groupBy("row").cogroup(held.groupBy("of")).applyInArrow(run, "row bigint, words binary, ones binary, ids binary, codes binary"), f"relation-{length + 1}")


def _cuts(phrases: dict[int, DataFrame], k: int) -> DataFrame:
    """Phrases of k words (w1.., f, lang, phrase) with l, r and score of the lowest-scoring cut, ties to the shorter first part."""
    p = phrases[k]
    for cut in range(1, k):
        for side, (x, y) in (("l", (0, cut)), ("r", (cut, k))):
            part = phrases[y - x]
            part = part.select(*[F.col(f"w{i + 1}").alias(f"_p{i}") for i in range(y - x)], F.col("f").alias(f"{side}{cut}"))
            p = p.join(part, reduce(lambda a, b: a & b, [p[f"w{x + i + 1}"] == part[f"_p{i}"] for i in range(y - x)])).drop(*[f"_p{i}" for i in range(y - x)])
    scored = [F.struct(F.expr(f"(cast({2 * SCALE} as decimal(7,0)) * cast(f as decimal(20,0))) div cast(l{c} + r{c} as decimal(20,0))").alias("score"),
                       F.lit(c).alias("cut"), F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")) for c in range(1, k)]
    best = F.array_min(F.array(*scored))
    return p.withColumn("_best", best).select("lang", "phrase", *[f"w{i + 1}" for i in range(k)], F.col("f").alias("a"), "_best.l", "_best.r", "_best.score")


def phrase_tables(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                  row_bytes: int = ROW_BYTES, part_keys: int = PART_KEYS) -> tuple[dict[int, DataFrame], DataFrame]:
    """Frequent phrases by number of words (w1, w2, ..: word ids; id, lang, phrase, f), staged, and lang, n."""
    rows = occurrences(docs, lang, text, row_bytes)
    each, words = frequent_words(rows, min_count)
    phrases = {1: words.select("id", "lang", F.col("word").alias("phrase"), "f", F.col("id").alias("w1"))}
    relation = first_relation(rows, each, words)
    total = rows.groupBy("lang").agg(F.sum("n").alias("n"))
    for k in range(1, max_words):
        cells = relation.agg(F.sum(F.length("ones")) / 4).first()[0] or 0
        groups = frequent_groups(group_counts(relation, k, 1 + int(cells) // part_keys), min_count, whose=k + 1 < max_words)
        if k + 1 < max_words:
            relation = next_relation(relation, groups, k)
        left = phrases[k].select(F.col("id").alias("a"), "lang", F.col("phrase").alias("_p"), *[f"w{i + 1}" for i in range(k)])
        right = phrases[1].select(F.col("id").alias("b"), F.col("phrase").alias("_w"))
        found = group_table(groups).join(left, "a").join(right, "b").select(
            "id", "lang", F.concat_ws(" ", "_p", "_w").alias("phrase"), "f", *[f"w{i + 1}" for i in range(k)], F.col("b").alias(f"w{k + 1}"))
        phrases[k + 1] = stage(found, f"phrases-{k + 1}")
    return phrases, total


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 subsumed_percent: int = SUBSUMED_PERCENT, row_bytes: int = ROW_BYTES, part_keys: int = PART_KEYS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language.

    A null lang counts as "und", as do all texts without such a column; a null or empty text has no words. Repeated rows
    count each. Phrases of equal score are ranked by count, then by the bytes of the
    phrase. A language without candidates has no rows, nor has an empty table; other columns play no part."""
    phrases, total = phrase_tables(docs, lang, text, min_count, max_words, row_bytes, part_keys)
    out = []
    for k in range(2, max_words + 1):
        scored = _cuts(phrases, k)
        keys = [f"w{i + 1}" for i in range(k)]
        holders = [phrases[m].select(*[F.col(f"w{at + i + 1}").alias(f"w{i + 1}") for i in range(k)], "f")
                   for m in range(k + 1, max_words + 1) for at in range(m - k + 1)]
        if holders:
            inside = reduce(DataFrame.unionByName, holders).groupBy(*keys).agg(F.max("f").alias("_longer"))
            scored = scored.join(inside, keys, "left").where(f"_longer is null or 100 * _longer < {subsumed_percent} * a")
        out.append(scored.select("lang", "phrase", "a", "l", "r", "score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = reduce(DataFrame.unionByName, out).withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = salted.withColumn("_k", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_k") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
