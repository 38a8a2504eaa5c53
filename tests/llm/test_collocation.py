import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import types as T

from txrisk.llm import collocation


def brute(rows, max_words, min_count, cover, top):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    f[(lang, *words[i:i + k])] += 1
    out = []
    for (lang, *words), a in f.items():
        if len(words) < 2 or a < min_count:
            continue
        cuts = [(10**6 * a * a // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        inside = any(
            b >= min_count and len(x) - 1 > len(words) and x[0] == lang and 100 * b >= cover * a
            and any(list(x[1 + i:1 + i + len(words)]) == words for i in range(len(x) - len(words)))
            for x, b in f.items()
        )
        if not inside:
            out.append((lang, " ".join(words), a, f[(lang, *words[:k])], f[(lang, *words[k:])], total[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(x[0], n + 1, *x[1:]) for n, x in enumerate(best)]
    return sorted(ranked)


SCHEMA = T.StructType([T.StructField("lang", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n", T.LongType()), T.StructField("word", T.StringType())])


@pytest.mark.parametrize("max_words,block_words,bucket_words,top", [(3, 1_000_000, 2_000_000, 2000), (3, 50, 100, 7), (4, 200, 1000, 2000), (2, 1, 10**9, 2000)])
def test_equals_brute_force(spark, max_words, block_words, bucket_words, top):
    r = random.Random(max_words)
    marks = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!", "\r\n", ";", " ", "\x1c"]
    rows = []
    for _ in range(120):
        text = "".join(r.choice(["a", "B", "c", "of the", "New York", "é", "É"]) + r.choice(marks) for _ in range(r.randint(0, 40)))
        rows.append((r.choice(["en", None, "und", "fr"]), text))
    rows += [("en", None), (None, ""), ("de", " . , "), ("en", "a B " * 3000), ("fr", "x")] + [("en", "of the New York city")] * 9
    docs = spark.createDataFrame([(*x, 1, "w") for x in rows], SCHEMA).repartition(3)
    got = collocation.collocations(docs, max_words, 10, 50, top, block_words, bucket_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, max_words, 10, 50, top)


def test_products_beyond_64_bits(spark):
    a, f, g = 3_037_000_500_000, 4_000_000_000_007, 5_000_000_000_003
    level = spark.createDataFrame([("en", "x y", [f, a], [g, a])], "lang string, phrase string, heads array<long>, tails array<long>")
    row = collocation._scored(level, 2).first()
    assert row["score"] == 10**6 * a * a // (f * g) and (row["l"], row["r"]) == (f, g)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert collocation.collocations(docs).count() == 0
    only_blank = spark.createDataFrame([("en", " ", 1, ""), (None, None, 1, "")], SCHEMA)
    assert collocation.collocations(only_blank).count() == 0


def test_equals_sql(spark):
    from .conftest import SF

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(con.execute(collocation.ORACLE_SQL).fetchall())
    assert want and sorted(map(tuple, collocation.op13_collocation(spark, SF).collect())) == want
