"""The stages one after another against plain Python on a small folder of tables."""

import brute
import corpus_pipeline


def test_pipeline(spark, tmp_path):
    word = lambda i: f"w{i * 7919 % 1_000_003}"
    text = lambda s, n=60: " ".join(word(s * 100 + i) for i in range(n))
    docs = [(i, text(i), "en", "s", 1) for i in range(40)]
    docs += [(50, docs[7][1], "en", "s", 1), (51, text(60) + " " + text(900, 12), "en", "s", 1), (52, text(61) + ' token = "abcdef0123456789"', "en", "s", 1), (53, None, None, None, None)]
    for i in range(100, 160):
        docs.append((i, text(i) + " vile", "en", "s", 1))
    labels = [(i, 1, int(i >= 100)) for i, *_ in docs if i != 53]
    for name, rows, schema in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"), ("benchmark", [(1, text(900, 12))], "item_id long, text string"), ("labels", labels, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {*range(40), 52, 53}
    plain = docs[42][1].replace('token = "abcdef0123456789', "[SECRET]")
    assert got[52]["decoded_sha256"] == brute.sha(plain) and got[3]["decoded_sha256"] == brute.sha(docs[3][1])
