"""The pipeline's stages, one by one, against brute-force versions of their decisions."""

import numpy as np
from pyspark.sql import functions as F
from test_nearcopies import brute_pairs, brute_roots, brute_shingles
from test_operators import brute_base, brute_contaminated

import corpus_pipeline as cp
from quillmine.llm import mixing, pii

SF = "/root/testdata/sf0.01"


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    labels = rows(spark.read.parquet(f"{SF}/labels.parquet"))
    kept = cp.drop_toxic(spark, docs, SF).cache()
    clean = {i for i, r in labels.items() if r.toxic == 0}
    assert kept.columns == cp.COLUMNS and len(clean & set(rows(kept))) > 0.97 * len(clean)

    sets = {i: brute_shingles(r.text) for i, r in rows(kept).items()}
    roots = set(brute_roots(sets, brute_pairs(sets)).values())  # texts without a word are copies of one another
    blank = sorted(i for i in roots if not sets[i])
    single = cp.drop_near_duplicates(spark, kept, SF).cache()
    assert set(rows(single)) == roots - set(blank[1:]) and single.columns == cp.COLUMNS

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {i for i, r in rows(single).items() if not brute_contaminated(r.text, bench)[1]}
    pure = cp.drop_contaminated(spark, single, SF).cache()
    assert set(rows(pure)) == want

    hidden = rows(cp.redact_pii(spark, pure, SF))
    for i, r in rows(pure).items():
        base = brute_base(r.text)
        assert (hidden[i].text != r.text) >= bool(base)
        assert not any(r.text[s:e] in hidden[i].text for s, e, k in base if k == "email")
        assert hidden[i].text == r.text or hidden[i].n_chars == len(hidden[i].text)

    mixed = cp.mix_sources(spark, pure, SF).groupBy("doc_id").agg(F.count("*").alias("n"))
    copies = {r.doc_id: r.copies for r in mixing.mix(pure).collect() if r.copies}
    assert {r.doc_id: r.n for r in mixed.collect()} == copies


def test_run_and_odd_rows(spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "mixing"]
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.columns == [*cp.COLUMNS, "copy"] and out.count() > 100
    odd = spark.createDataFrame([(1, "same text here", "en", "a", 3), (1, "same text here", "en", "a", 3), (None, "other words in it", None, None, None), (2, None, None, "a", None), (3, "", "en", "a", 0), (4, "call a@b.co", "en", "b", 11)], "doc_id long, text string, lang string, source string, n_chars long")
    assert cp.drop_near_duplicates(spark, odd, SF).count() == 4  # the repeated row and one of the two empty texts go
    assert cp.drop_contaminated(spark, odd, SF).count() == 6
    assert cp.redact_pii(spark, odd, SF).where("text = 'call <EMAIL>' AND n_chars = 12").count() == 1
    mixed = cp.mix_sources(spark, odd, SF)
    assert mixed.select("doc_id").distinct().count() >= 1 and np.isfinite(mixed.count())
    for _, stage in cp.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0
    assert pii.KINDS == ("email", "ip", "card", "phone")
