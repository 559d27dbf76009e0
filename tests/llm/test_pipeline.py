import random

import public_tokenizers

import corpus_pipeline
from quire.llm.packing import encoder
from tests.conftest import frame


def test_planted_cases(spark, tmp_path):
    rng = random.Random(11)
    vocab = [f"w{i:03d}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(900)]

    def prose(n):
        return " ".join(rng.choices(vocab, k=n))

    clean = [(i, prose(120), "en", "s", 0) for i in range(60)]
    exact = [(100 + k, clean[0][1], "en", "s", 0) for k in range(4)]
    words = clean[1][1].split()
    words[60] = "edited"
    near = [(200, " ".join(words), "en", "s", 0)]
    passage = prose(60)
    shared = [(300 + k, f"{prose(40)}\n{passage}\n{prose(40)}", "en", "s", 0) for k in range(5)]
    item = prose(30)
    leaked = [(400, f"{prose(50)} {item} {prose(50)}", "en", "s", 0)]
    toxic = [(500 + k, f"{prose(60)} worthless stupid {prose(20)}", "en", "s", 0) for k in range(30)]
    rows = clean + exact + near + shared + leaked + toxic + [(600, None, None, None, None), (601, "", "en", "s", 0)]
    for name, data, schema in (
        ("documents", rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        ("labels", [(r[0], 0, int(r[0] >= 500)) for r in clean + toxic], "doc_id bigint, quality int, toxic int"),
        ("benchmark", [(1, item)], "item_id bigint, text string"),
    ):
        frame(spark, data, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        seen[name] = docs
    ids = {name: {r["doc_id"] for r in df.select("doc_id").collect()} for name, df in seen.items()}
    everyone = {r[0] for r in rows}
    assert everyone - ids["toxicity"] == {r[0] for r in toxic}
    kept = {r["doc_id"]: r["text"] for r in seen["line_dedup"].collect()}
    assert passage in kept[300] and not any(passage in kept[300 + k] for k in range(1, 5))
    assert not set(kept) & {r[0] for r in exact} and all(kept[r[0]] == r[1] for r in clean)
    assert {r[0] for r in clean} <= ids["near_dedup"] and 200 not in ids["near_dedup"]
    assert ids["near_dedup"] - ids["decontamination"] == {400}
    tokens = {r["doc_id"]: r["n"] for r in seen["packing"].groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    encode = encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert tokens[clean[5][0]] == len(encode.direct(clean[5][1])) + 1
    assert ids["packing"] == ids["decontamination"]
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in whole.collect()} == ids["packing"]
