import random

import duckdb
import pytest
from pyspark.sql import functions as F

from popflow.llm import mixing


def plain_share(budget, children):
    """Water-filling by repeated rounds; children: name -> (weight, cap)."""
    got, open_ = {}, {k: v for k, v in children.items() if v[0] > 0}
    while open_:
        total = sum(w for w, _ in open_.values())
        full = {k for k, (w, cap) in open_.items() if cap * total <= budget * w}
        if not full:
            return got | {k: budget * w // total for k, (w, _) in open_.items()}
        for k in full:
            got[k] = open_.pop(k)[1]
            budget -= got[k]
    return got


@pytest.mark.parametrize("budget", [0, 7, 100, 1000, 5000])
def test_shortages_go_to_siblings(spark, budget):
    rng = random.Random(budget)
    children = {f"c{i}": (rng.randint(0, 5), rng.randint(0, 400)) for i in range(9)}
    df = spark.createDataFrame([(k, w, cap, budget) for k, (w, cap) in children.items()], "name string, w long, cap long, budget long")
    got = {r.name: r.got for r in mixing.share_out(df, [], "name").collect()}
    want = plain_share(budget, children)
    assert got == want
    able = sum(cap for w, cap in children.values() if w)
    assert min(budget, able) - len(children) <= sum(got.values()) <= min(budget, able)


def docs_for(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def both(spark, docs, tmp_path, **mix):
    path = str(tmp_path / "documents")
    docs.write.parquet(path)
    back = spark.read.parquet(path)
    cols = ["doc_id", "domain", "lang", "source", "n_tokens", "n_epochs"]
    got = mixing.mix(back, **mix)
    assert got.columns == cols
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({mixing.oracle(**mix)})").fetchall()
    return sorted(map(tuple, got.collect()), key=str), sorted(want, key=str)


@pytest.mark.parametrize("share,epochs", [(0.3, 1), (0.5, 3), (1.7, 3), (9.0, 2)])
def test_matches_the_row_by_row_sql(spark, tmp_path, share, epochs):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["en", "de", "fr", None]),
             rng.choice(["src0", "src0", "src1", "src2", "src7", "other", None]), None) for i in range(400)]
    rows += [(900, None, "en", "src0", 1), (901, "", "en", "src0", 0), (None, "a b c", "en", "src0", 3), rows[5], rows[5],
             (950, "only empty", "xx", "src3", 0), (951, "a " * 30_000, "en", "src1", 0), (952, None, "yy", "src3", 0)]
    docs = docs_for(spark, rows).withColumns({"full": F.lit(1), "cut": F.lit("x"), "domain": F.lit("clash")})
    mix = dict(budget_share=share, epochs=epochs, seed=5, domain_weights={"d0": 3, "d1": 1}, lang_weights={"en": 2, "xx": 0})
    got, want = both(spark, docs, tmp_path, **mix)
    assert got == want and got


def test_pipeline_form_takes_the_same_documents(spark):
    rng = random.Random(3)
    docs = docs_for(spark, [(i, "w " * rng.randint(1, 9), rng.choice("ab"), rng.choice(["s1", "s2"]), 1) for i in range(200)])
    a = {(r.doc_id, r.n_epochs) for r in mixing.mix(docs, budget_share=0.4).collect()}
    kept = mixing.mix_documents(docs, budget_share=0.4)
    assert kept.columns == [*docs.columns, "n_epochs"]
    assert {(r.doc_id, r.n_epochs) for r in kept.collect()} == a


def test_empty_table(spark):
    assert mixing.mix(docs_for(spark, [])).collect() == []
