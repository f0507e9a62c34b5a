"""Sketches, the widest table, don't stay on disk for the rounds that don't read them."""

from aircascade.llm import parity


def test_sketches_go_before_buckets_are_made(spark, monkeypatch):
    log, store, drop = [], parity.stored, parity.dropped
    monkeypatch.setattr(parity, "stored", lambda df, name: log.append(name) or store(df, name))
    monkeypatch.setattr(parity, "dropped", lambda df: log.append("keys dropped" if "keys" in df.columns and "doc_id" in df.columns else "dropped") or drop(df))
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(3, text), (2, text), (5, text + " more"), (7, "other words of a text"), (9, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity.similar_documents(docs).collect()}
    assert got == {2: (57, 2), 3: (57, 2), 5: (58, 2), 7: (2, 7), 9: (0, 9)}
    assert log.index("keys dropped") < log.index("buckets"), log


def test_only_sets_of_near_pairs_are_moved(spark, monkeypatch):
    """Where Spark can't broadcast, sets that no near pair names are filtered out before they are shuffled."""
    plans, store = [], parity.stored
    monkeypatch.setattr(parity, "stored", lambda df, name: (name == "links" and plans.append(df._jdf.queryExecution().executedPlan().toString()), store(df, name))[1])
    monkeypatch.setattr(parity, "BLOCK", 5)
    texts = [" ".join(f"v{f}w{i}" for i in range(80)) + " x" * k for f in range(3) for k in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        got = {r.doc_id: r.component_id for r in parity.similar_documents(docs).collect()}
    finally:
        spark.conf.set(name, before)
    assert got == {i: i // 3 * 3 for i in range(9)}
    assert plans and all("might_contain" in p for p in plans), plans
