import random

import pytest

from wattloom.operators import model

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def trained(spark):
    random.seed(6)
    rows = [(k, random.random(), random.random() * 5, float(random.randrange(4)) if k % 50 else None) for k in range(600)]
    frame = spark.createDataFrame([(*r, int(r[1] * 3 + (r[2] > 2) + random.random() > 2)) for r in rows], "id int, a double, b double, c double, label int")
    return frame, model.train_forest(frame, features=FEATURES, key="id", folds=2, grid={"numTrees": [7], "maxDepth": [4]})


def test_exported_trees_score_like_the_model(spark, trained, monkeypatch):
    frame, forest = trained
    want = {r["id"]: (r["y_pred"], r["pred_0"], r["pred_1"]) for r in model.score_forest(forest, frame, features=FEATURES).collect()}
    nodes = model.node_table(forest, FEATURES)
    for most in (model.MOST_NODES, 1):
        monkeypatch.setattr(model, "MOST_NODES", most)
        got = {r["id"]: (r["y_pred"], r["pred_0"], r["pred_1"]) for r in model.score_nodes(frame, nodes, ["id"], FEATURES).collect()}
        assert got.keys() == want.keys() and len(got) == 588
        assert all(g[0] == w[0] and abs(g[1] - w[1]) < 1e-9 and abs(g[2] - w[2]) < 1e-9 for g, w in ((got[i], want[i]) for i in got))


def test_the_table_has_every_node_once(spark, trained):
    _, forest = trained
    rows = model.node_table(forest, FEATURES).collect()
    assert len({(r["tree"], r["node"]) for r in rows}) == len(rows) and {r["tree"] for r in rows} == set(range(7))
    at = {(r["tree"], r["node"]): r for r in rows}
    for r in rows:
        assert (r["feature"] is None) == (r["shares"] is not None)
        if r["feature"]:
            assert (r["tree"], r["lo"]) in at and (r["tree"], r["hi"]) in at
        else:
            assert abs(sum(r["shares"]) - 1) < 1e-12


def test_confusion_of_the_scores(spark, trained):
    frame, forest = trained
    scored = model.score_forest(forest, frame, features=FEATURES)
    counts = {(r["label"], r["y_pred"]): r["n"] for r in model.confusion(scored).collect()}
    assert sum(counts.values()) == 588 and counts[0, 0] + counts[1, 1] > 500


def test_the_forest_query_reads_texts_once(spark):
    """What training and scores read is the staged shares, and they are those of plain replacements."""
    from wattloom import queries

    sf = "/root/testdata/sf0.001"
    assert not [f for f in queries.score_forest(spark, sf).inputFiles() if "documents.parquet" in f]
    docs = spark.createDataFrame([(1, "A b|c.\nÄ😀 Z?!"), (2, ""), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["marks"], r["stops"], r["capitals"]) for r in queries.text_shares(docs).collect()}
    assert got == {1: (2 / 13, 2 / 13, 2 / 13), 2: (0.0, 0.0, 0.0), 3: (None, None, None)}
