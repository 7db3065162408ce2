from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qamill.functions.text import PY_WS, is_blank, word_count
from qamill.operators import order as O


def test_split_and_chunk_sizes_for_every_n_up_to_200(spark):
    sizes = list(range(0, 201))
    # one group of n rows for every n, all in one job
    df = (spark.createDataFrame([(n,) for n in sizes if n > 0], "n int")
          .select("n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
          .select("n", (F.col("n") * 1000 + F.col("i")).cast("bigint").alias("id")))
    ranked = O.hashed_rank(df, "id", partition_by=["n"])
    nt = F.floor(F.col("n_total") * F.lit(0.6)).cast("bigint")
    nv = F.floor(F.col("n_total") * F.lit(0.2)).cast("bigint")
    split = (F.when(F.col("pos") < nt, "training").when(F.col("pos") < nt + nv, "validation")
             .otherwise("evaluation"))
    ev_pos = F.col("pos") - nt - nv
    m = F.col("n_total") - nt - nv
    got = (ranked.withColumn("split", split)
           .withColumn("batch", F.when(F.col("split") == "evaluation", O.chunk_column(ev_pos, m, 3)))
           .groupBy("n").agg(
               F.count_if(F.col("split") == "training").alias("t"),
               F.count_if(F.col("split") == "validation").alias("v"),
               F.count_if(F.col("split") == "evaluation").alias("e"),
               F.count_if(F.col("batch") == 1).alias("b1"),
               F.count_if(F.col("batch") == 2).alias("b2"),
               F.count_if(F.col("batch") == 3).alias("b3"),
               F.min("pos").alias("lo"), F.max("pos").alias("hi"),
               F.countDistinct("pos").alias("distinct_pos"))
           .collect())
    by_n = {r["n"]: r for r in got}
    for n in sizes[1:]:
        r = by_n[n]
        t, v = int(n * 0.6), int(n * 0.2)
        e = n - t - v
        assert (r["t"], r["v"], r["e"]) == (t, v, e), n
        k = e // 3
        assert (r["b1"], r["b2"], r["b3"]) == ((k, k, e - 2 * k) if k else (0, 0, e)), n
        assert (r["lo"], r["hi"], r["distinct_pos"]) == (0, n - 1, n), n


TEXT = st.text(alphabet=st.sampled_from(list(PY_WS) + list("ab é​­") + ["\U0001F600"]),
               max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_blank_and_words_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", is_blank("t").alias("b"), word_count("t").alias("w")).collect()
    for r in rows:
        t = texts[r["i"]]
        assert r["b"] == (t.strip() == "")
        assert r["w"] == len(t.split())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=30))
def test_encoder_matches_python_split(spark, texts):
    from qamill.operators import encode as E

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, prompt string")
    vocab = E.build_vocab(df, "prompt", max_vocab=3)
    table = {r["word"]: r["token_id"] for r in vocab.collect()}
    got = {r["id"]: r for r in E.encode(df, vocab, max_len=5, method="map").collect()}
    for i, t in enumerate(texts):
        ws = (t or "").split()[:5]
        ids = [table.get(w, 0) for w in ws]
        assert got[i]["input_ids"] == ids + [1] * (5 - len(ids))
        assert got[i]["attention_mask"] == [1] * len(ids) + [0] * (5 - len(ids))
