import math
import random
from collections import Counter

import numpy as np

from riskframe.llm import language_ppm as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = [r for r in L.identify(docs).collect() if r["held_out"]]
    assert len(rows) > 100
    assert np.mean([r["lang_pred"] == truth[r["id"]] for r in rows]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_code_lengths_match_a_plain_model(spark):
    texts = [("aa", "abc abd abc."), ("bb", "xyz xyz 12 é")]
    model = L.fit(spark.createDataFrame(texts, "lang string, text string"))
    plain = {}
    for name, text in texts:
        c = [0, 0] + [int(L.CLASS[b]) for b in text.encode()]
        tri = Counter(zip(c, c[1:], c[2:]))
        plain[name] = tri

    def bits(name, text):
        c, total = [0, 0] + [int(L.CLASS[b]) for b in text.encode()], 0
        tri = plain[name]
        uni, pair = Counter(), Counter()
        for (a, b, s), n in tri.items():
            uni[s] += n
            pair[b, s] += n
        for a, b, s in zip(c, c[1:], c[2:]):
            for counts in ({k[2]: n for k, n in tri.items() if k[:2] == (a, b)}, {k[1]: n for k, n in pair.items() if k[0] == b}, uni):
                if not counts:
                    continue
                if s in counts:
                    total += round(-math.log2(counts[s] / (sum(counts.values()) + len(counts))) * L.BIT)
                    break
                total += round(-math.log2(len(counts) / (sum(counts.values()) + len(counts))) * L.BIT)
            else:
                total += round(-math.log2(1 / L.A) * L.BIT)
        return total

    index = model.lookup()
    for text in ("abc", "xyz é", "zzz 9!", "qé abd"):
        buf = np.frombuffer(text.encode(), np.uint8)
        code = L._contexts(buf, np.array([0, len(buf)]))
        j = index[code]
        cost = np.where((j == 0)[:, None], model.escape[code // L.A] + model.short[code % (L.A * L.A)], model.full[j])
        assert cost.sum(axis=0).tolist() == [bits("aa", text), bits("bb", text)]


def test_undetermined_texts_and_empty_tables(spark):
    rows = [(1, None, "en"), (2, "123 !", "en"), (3, "", None), (None, "héllo", None), (5, "日本語", None), (7, "the words", "en"), (7, "the words", "en")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, score int")
    got = {(r["id"], r["key"]): r for r in L.identify(df).collect()}
    by_id = {i: r for (i, _), r in got.items()}
    assert [by_id[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and by_id[5]["lang_pred"] == "en" and by_id[None]["lang_pred"] == "en"
    assert L.identify(df.limit(0)).collect() == []
    unlabelled = df.drop("lang")
    assert {r["lang_pred"] for r in L.identify(unlabelled).collect()} == {"und"}
    kept = L.stage_language(spark, df, SF)
    assert kept.columns == df.columns and kept.count() == 4


def test_result_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = sorted(tuple(r) for r in L.identify(docs).collect())
    b = sorted(tuple(r) for r in L.identify(docs.repartition(7)).collect())
    assert a == b


def test_stage_rejects_gibberish_and_unlearned_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rnd = random.Random(5)
    strange = [" ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(2, 9))) for _ in range(rnd.choice([10, 30, 100]))) for _ in range(30)]
    strange += ["Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
                "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto."]
    clean = [" ".join(r["text"].split()[:12]) for r in docs.filter("n_chars > 300").orderBy("doc_id").limit(60).collect()]
    extra = spark.createDataFrame([(-1 - i, x) for i, x in enumerate(strange + clean)], "doc_id long, text string")
    left = {r["doc_id"] for r in L.stage_language(spark, docs.unionByName(extra, allowMissingColumns=True), SF).collect()}
    assert not left & {-1 - i for i in range(len(strange))}
    assert sum(-1 - len(strange) - i in left for i in range(len(clean))) >= 58
    ids = {r["doc_id"] for r in docs.collect()}
    assert len(ids - left) <= 0.01 * len(ids)


def test_held_out_labels_teach_nothing(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    one, two = (sorted(map(str, L.identify(d).select("id", "held_out", "lang_pred", "score").collect())) for d in (docs, other))
    assert one == two
