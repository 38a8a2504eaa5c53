"""Phrase collocations by set-oriented relational mining (operator 13).

The occurrences of words are one relation, sorted by piece and position and written once, in blocks of whole
documents. Level k joins the relation of frequent phrases of k-1 words with itself where one occurrence starts
a position after the other in the same piece (both are sorted, so this merge never leaves a block), counts the
groups, and semi-joins the occurrences with the groups that are frequent before the next level extends them.
A block hands on each of its groups once with its count, so even the most frequent word or phrase is one entry
per block in the shuffle, and no piece of text, only keys and counts, is ever exchanged. Phrases travel packed:
a block's groups are dealt to buckets by their hash, and one row holds a block's part of a bucket, sorted and
compressed; a bucket's parts are counted together, and every block gets back which of its groups are frequent.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, partition_id, read_table

MAX_WORDS = 3
MIN_COUNT = 10
COVER_PERCENT = 50
TOP = 2000
#: Occurrences that one block holds, about: whole documents are added until there are so many.
BLOCK_WORDS = 1_000_000
#: Occurrences whose groups one bucket counts, about.
BUCKET_WORDS = 2_000_000
#: Characters of text split into words at a time, and groups in one Arrow batch.
SPLIT_CHARS = 1 << 20
BATCH_ROWS = 1 << 16
#: Parts of a language whose best phrases are cut to the report's length before they meet.
SALTS = 64

#: The marks that end a piece.
_MARKS = b".,;:!?\n\x0b\x0c\r"
#: A byte that no UTF-8 text holds.
_BREAK = b"\xff"
_TO_BREAK = bytes.maketrans(_MARKS, _BREAK * len(_MARKS))

#: Bits of a block's number within its task, and of a group's number within its block.
_BLOCK_BITS, _LOCAL_BITS = 16, 25

_WORDS = "block long, at binary, ids binary, own long, lang string, word string, n int"
_PARTS = "block long, at binary, ids binary, bucket long, first int, left binary, right binary, n binary"
_COUNTED = "id long, left long, right long, f long, block long, first int, local binary, ids binary"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _squeeze(numbers: np.ndarray, kind: str = "<i4") -> bytes:
    """Numbers compressed byte by byte: first all lowest bytes, then the next ones."""
    import zstandard

    planes = np.ascontiguousarray(numbers, kind).view(np.uint8).reshape(len(numbers), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _spread(data: bytes, kind: str = "<i4") -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind)[:, 0]


def _batch(schema: pa.Schema, n_rows: int, /, **columns) -> pa.RecordBatch:
    """``n_rows`` rows of ``schema``; a column that isn't given is null."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n_rows, f.type) for f in schema], schema=schema)


def _occurrence_row(block: int, at: np.ndarray, ids: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    """The sorted relation (place, id) of a block; places as steps from the one before."""
    return _batch(schema, 1, block=[block], at=[_squeeze(np.diff(at, prepend=0))], ids=[_squeeze(ids)])


class _Numbers(dict):
    """Numbers of a language's words; ``names`` lists the words of all languages in that order."""

    def __init__(self, lang: str, names: list[tuple[str, bytes]]):
        self.lang, self.names = lang, names
        self[_BREAK] = -1

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append((self.lang, word))
        return number


class _Block:
    """Occurrences of whole documents; words are numbered per language, a piece's end takes one place."""

    def __init__(self):
        self.at, self.ids, self.place = array("i"), array("i"), 0
        self.words: dict[str, _Numbers] = {}
        self.names: list[tuple[str, bytes]] = []

    def add(self, lang: str, texts: list[bytes]):
        """Texts of one language; every text ends a piece."""
        tokens = (_BREAK.join(texts) + _BREAK).lower().translate(_TO_BREAK).replace(_BREAK, b" " + _BREAK + b" ").split()
        if lang not in self.words:
            self.words[lang] = _Numbers(lang, self.names)
        ids = np.fromiter(map(self.words[lang].__getitem__, tokens), np.int32, len(tokens))
        at = np.flatnonzero(ids >= 0).astype(np.int32)
        self.ids.frombytes(ids[at].tobytes())
        self.at.frombytes((at + np.int32(self.place)).tobytes())
        self.place += len(tokens)

    def rows(self, block: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The occurrences, then the words with their counts; ``own`` holds block and number, and names no other word."""
        at, ids, total = np.frombuffer(self.at, np.int32), np.frombuffer(self.ids, np.int32), len(self.names)
        if not total:
            return
        if total >> _LOCAL_BITS:
            raise ValueError("a text holds more different words than a block can number")
        yield _occurrence_row(block, at, ids, schema)
        n = np.bincount(ids, minlength=total)
        for a in range(0, total, BATCH_ROWS):
            names = self.names[a:a + BATCH_ROWS]
            own = np.arange(a, a + len(names)) + (block << _LOCAL_BITS)
            yield _batch(schema, len(names), own=own, lang=[x for x, _ in names], word=[w.decode() for _, w in names], n=n[a:a + len(names)])


def _tokenise(block_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, number, block = _schema(_WORDS), partition_id() << _BLOCK_BITS, _Block()
        for batch in batches:
            waiting, chars = defaultdict(list), 0
            langs = batch.column(0).to_pylist()
            for k, lang in enumerate(langs):
                text = batch.column(1)[k].as_py()
                waiting[lang].append(text)
                chars += len(text)
                if chars >= SPLIT_CHARS or k == len(langs) - 1:
                    for name, texts in waiting.items():
                        block.add(name, texts)
                    waiting, chars = defaultdict(list), 0
                if len(block.ids) >= block_words:
                    yield from block.rows(number, schema)
                    number, block = number + 1, _Block()
        yield from block.rows(number, schema)

    return run


def _buckets(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    key = (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    key ^= key >> np.uint64(29)
    return ((key * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(33)).astype(np.int64) % n


def _known_words(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and ids of a block's frequent words."""
    known = row["known"].values
    return known.field("local").to_numpy(), known.field("id").to_numpy()


def _known_groups(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The same of its frequent phrases, from the buckets' packed answers."""
    parts = row["known"].as_py()
    return (np.concatenate([x["first"] + _spread(x["local"]) for x in parts]), np.concatenate([_spread(x["ids"], "<i8") for x in parts]))


def _extend(known, n_buckets: int, last: bool):
    """Blocks of frequent phrases -> their groups one word longer by bucket, and the occurrences if a level follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(_PARTS)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in ("block", "at", "ids", "known")}
                block, at, ids = row["block"].as_py(), np.cumsum(_spread(row["at"].as_py()), dtype=np.int32), _spread(row["ids"].as_py())
                local, group = known(row)
                # Semi-join: occurrences of groups that aren't frequent go.
                name = np.full(int(max(ids.max(), local.max())) + 1, -1, np.int32)
                name[local] = np.arange(len(local))
                ids = name[ids]
                stay = ids >= 0
                at, ids = at[stay], ids[stay]
                # Merge join of two sorted relations: the occurrence one place on is the next one, if any.
                here = np.flatnonzero(at[1:] == at[:-1] + 1)
                key, ids, n = np.unique(ids[here].astype(np.int64) * len(local) + ids[here + 1], return_inverse=True, return_counts=True)
                if not len(key):
                    continue
                left, right = group[key // len(local)], group[key % len(local)]
                bucket = _buckets(left, right, n_buckets)
                # Groups are numbered by bucket, so a bucket's part of a block is a run of numbers.
                order = np.lexsort((right, left, bucket))
                left, right, n, bucket = left[order], right[order], n[order], bucket[order]
                if not last:
                    number = np.empty(len(order), np.int32)
                    number[order] = np.arange(len(order))
                    yield _occurrence_row(block, at[here], number[ids], schema)
                starts = np.flatnonzero(np.diff(bucket, prepend=-1))
                runs = [slice(a, b) for a, b in zip(starts, [*starts[1:], len(bucket)])]
                yield _batch(
                    schema, len(runs), block=np.full(len(runs), block), bucket=bucket[starts], first=starts,
                    left=[_squeeze(np.diff(left[r], prepend=0), "<i8") for r in runs], right=[_squeeze(right[r], "<i8") for r in runs],
                    n=[_squeeze(n[r]) for r in runs],
                )

    return run


def _count(min_count: int, last: bool):
    """Parts of buckets, sorted by bucket -> the frequent groups, and for every block which of its own are frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, current, parts = _schema(_COUNTED), None, []

        def close():
            left, right, n = (np.concatenate([p[c] for p in parts]) for c in (2, 3, 4))
            order = np.lexsort((right, left))
            a, b = left[order], right[order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            f = np.add.reduceat(n[order].astype(np.int64), np.flatnonzero(new))
            often = np.flatnonzero(f >= min_count)
            if not len(often):
                return
            at = np.flatnonzero(new)[often]
            ids = (current << 32) + np.arange(len(often))
            yield _batch(schema, len(often), id=ids, left=a[at], right=b[at], f=f[often])
            if last:
                return
            id_of = np.full(len(f), -1)
            id_of[often] = ids
            own = np.empty(len(order), np.int64)
            own[order] = id_of[np.cumsum(new) - 1]
            cuts = np.cumsum([len(p[2]) for p in parts])[:-1]
            rows = []
            for (block, first, *_), part in zip(parts, np.split(own, cuts)):
                local = np.flatnonzero(part >= 0)
                if len(local):
                    rows.append((block, first, _squeeze(local), _squeeze(part[local], "<i8")))
            if rows:
                yield _batch(schema, len(rows), **dict(zip(("block", "first", "local", "ids"), map(list, zip(*rows)))))

        for batch in batches:
            for k in range(batch.num_rows):
                bucket, block, first, left, right, n = (batch.column(c)[k].as_py() for c in ("bucket", "block", "first", "left", "right", "n"))
                if bucket != current and parts:
                    yield from close()
                    parts = []
                current = bucket
                parts.append((block, first, np.cumsum(_spread(left, "<i8")), _spread(right, "<i8"), _spread(n)))
        if parts:
            yield from close()

    return run


def _frequent_words(words: DataFrame, min_count: int) -> DataFrame:
    """own, id, f, lang, word: words that are frequent in all blocks together, by the least ``own``.

    One exchange serves the group-count and the semi-join; a word has at most one row per block. Only the row
    that names a word keeps its text.
    """
    w = Window.partitionBy("lang", "word")
    found = words.withColumn("f", F.sum("n").over(w)).withColumn("id", F.min("own").over(w)).where(F.col("f") >= min_count)
    return found.select("own", "id", "f", *[F.when(F.col("own") == F.col("id"), F.col(c)).alias(c) for c in ("lang", "word")])


def _joined(blocks: DataFrame, known: DataFrame) -> DataFrame:
    return blocks.join(known, "block").select("block", "at", "ids", "known")


def frequent_phrases(
    docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, block_words: int = BLOCK_WORDS, bucket_words: int = BUCKET_WORDS,
) -> list[DataFrame]:
    """Phrases of 1, 2, ... words that occur at least ``min_count`` times in their language.

    Each level has id, lang, phrase, heads and tails (counts of the phrase's first, and last, 1, 2, ... words;
    the last entry is its own count), and for longer levels left and right (ids of the phrase without its last
    and first word) as well. The first level has total, the words of the language, besides.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text.alias("text"))
    table = materialize(rows.mapInArrow(_tokenise(block_words), _WORDS), "op13-words")
    blocks, words = table.where("at is not null").select("block", "at", "ids"), table.where("at is null").drop("block", "at", "ids")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    found = materialize(_frequent_words(words, min_count), "op13-frequent")
    own = F.array("f")
    ones = found.where("own = id").join(totals, "lang")
    levels = [materialize(ones.select("id", "lang", F.col("word").alias("phrase"), own.alias("heads"), own.alias("tails"), "total"), "op13-level1")]
    n_buckets = 1 + (words.agg(F.sum("n")).first()[0] or 0) // bucket_words
    local = F.col("own").bitwiseAND((1 << _LOCAL_BITS) - 1).alias("local")
    known = found.groupBy(F.shiftright("own", _LOCAL_BITS).alias("block")).agg(F.collect_list(F.struct(local, "id")).alias("known"))
    decode = _known_words
    for k in range(2, max_words + 1):
        last = k == max_words
        grown = _joined(blocks, known).mapInArrow(_extend(decode, n_buckets, last), _PARTS)
        if not last:
            grown = materialize(grown, f"op13-parts{k}")
        parts = grown.where("at is null").drop("at", "ids").repartition("bucket").sortWithinPartitions("bucket", "block")
        counted = materialize(parts.mapInArrow(_count(min_count, last), _COUNTED), f"op13-counted{k}")
        a = levels[-1].select(F.col("id").alias("left"), "lang", F.col("phrase").alias("start"), "heads")
        b = levels[-1].select(F.col("id").alias("right"), F.col("phrase").alias("end"), "tails")
        longer = counted.where("id is not null").select("id", "left", "right", "f").join(a, "left").join(b, "right").select(
            "id", "lang",
            # A left part and the last word of the right one; words hold no space.
            F.concat_ws(" ", "start", F.substring_index("end", " ", -1)).alias("phrase"),
            F.concat("heads", own).alias("heads"), F.concat("tails", own).alias("tails"), "left", "right",
        )
        levels.append(materialize(longer, f"op13-level{k}"))
        if not last:
            blocks = grown.where("at is not null").select("block", "at", "ids")
            known = counted.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("first", "local", "ids")).alias("known"))
            decode = _known_groups
    return levels


def _scored(level: DataFrame, k: int) -> DataFrame:
    """lang, phrase, a, score, l, r of the lowest-scoring cut; 128-bit decimals keep every product exact."""
    cuts = [
        f"struct(cast(((cast(a as decimal(19,0)) * cast(a as decimal(19,0))) * 1000000BD) div (cast(heads[{j - 1}] as decimal(19,0)) * cast(tails[{k - j - 1}] as decimal(19,0))) as bigint) as score, "
        f"{j} as cut, heads[{j - 1}] as l, tails[{k - j - 1}] as r)"
        for j in range(1, k)
    ]
    least = cuts[0] if k == 2 else f"least({', '.join(cuts)})"
    return level.withColumn("a", F.expr(f"heads[{k - 1}]")).select("lang", "phrase", "a", F.expr(least).alias("best")).select("lang", "phrase", "a", "best.*").drop("cut")


def collocations(
    docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, cover_percent: int = COVER_PERCENT, top: int = TOP,
    block_words: int = BLOCK_WORDS, bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    A null language is ``und``, a null text empty; empty texts and tables add nothing. Every row counts, also
    repeated rows and ids. A text longer than a block is a block of its own. Equal scores are ranked by count,
    then by the phrase's bytes, which differ. Only ``lang`` and ``text`` are read, so other columns may have any
    name. Counts stay exact up to 10**16 occurrences of a phrase.
    """
    if max_words < 2:
        raise ValueError("a phrase has at least two words")
    levels = frequent_phrases(docs, max_words, min_count, block_words, bucket_words)
    totals = levels[0].select("lang", "total").distinct()
    found = None
    for k in range(2, max_words + 1):
        level = levels[k - 1]
        if k < max_words:
            # A longer candidate around a phrase is never more frequent than the one that adds a single word.
            longer = levels[k].select("left", "right", F.element_at("heads", -1).alias("longer"))
            around = longer.select(F.col("left").alias("id"), "longer").unionByName(longer.select(F.col("right").alias("id"), "longer"))
            around = around.groupBy("id").agg(F.max("longer").alias("longer"))
            level = level.join(around, "id", "left").where(f"longer is null or 100 * longer < {int(cover_percent)} * element_at(heads, -1)")
        part = _scored(level, k)
        found = part if found is None else found.unionByName(part)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # No language is sorted in one task: its parts are cut to the report's length first.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    found = found.withColumn("nth", F.row_number().over(part)).where(F.col("nth") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return found.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )


def op13_collocation(spark, sf_dir):
    return collocations(read_table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
), f1 AS (
  SELECT lang, word, count(*) AS f FROM (SELECT lang, unnest(words) AS word FROM w) GROUP BY 1, 2
), total AS (
  SELECT lang, sum(f) AS n FROM f1 GROUP BY 1
), f2 AS (
  SELECT lang, a1, a2, count(*) AS f
  FROM (SELECT lang, unnest(words[1:len(words) - 1]) AS a1, unnest(words[2:]) AS a2 FROM w WHERE len(words) >= 2) GROUP BY 1, 2, 3
), f3 AS (
  SELECT lang, a1, a2, a3, count(*) AS f
  FROM (SELECT lang, unnest(words[1:len(words) - 2]) AS a1, unnest(words[2:len(words) - 1]) AS a2, unnest(words[3:]) AS a3 FROM w WHERE len(words) >= 3)
  GROUP BY 1, 2, 3, 4 HAVING count(*) >= {MIN_COUNT}
), around AS (
  SELECT lang, a1, a2, max(f) AS longer
  FROM (SELECT lang, a1, a2, f FROM f3 UNION ALL SELECT lang, a2, a3, f FROM f3) GROUP BY 1, 2, 3
), c AS (
  SELECT f2.lang, f2.a1 || ' ' || f2.a2 AS phrase, f2.f AS a, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.word = f2.a1 JOIN f1 y ON y.lang = f2.lang AND y.word = f2.a2
  LEFT JOIN around o ON o.lang = f2.lang AND o.a1 = f2.a1 AND o.a2 = f2.a2
  WHERE f2.f >= {MIN_COUNT} AND (o.longer IS NULL OR 100 * o.longer < {COVER_PERCENT} * f2.f)
), c3 AS (
  SELECT f3.lang, f3.a1 || ' ' || f3.a2 || ' ' || f3.a3 AS phrase, f3.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.word = f3.a1 JOIN f1 z ON z.lang = f3.lang AND z.word = f3.a3
  JOIN f2 xy ON xy.lang = f3.lang AND xy.a1 = f3.a1 AND xy.a2 = f3.a2 JOIN f2 yz ON yz.lang = f3.lang AND yz.a1 = f3.a2 AND yz.a2 = f3.a3
), scored AS (
  SELECT lang, phrase, a, l, r, 1000000::HUGEINT * a * a // (l::HUGEINT * r) AS score FROM c
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
  FROM (SELECT *, 1000000::HUGEINT * a * a // (l1::HUGEINT * r1) AS s1, 1000000::HUGEINT * a * a // (l2::HUGEINT * r2) AS s2 FROM c3)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored
)
SELECT ranked.lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= {TOP}
"""
