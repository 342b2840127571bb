"""Approximate neighbours, and exact ones in tables of any shape."""

import numpy as np
import pytest

from seriesml.operators import neighbours


def table(spark, x, label=0):
    return spark.createDataFrame([(i, v.tolist(), label) for i, v in enumerate(np.asarray(x, dtype=float))], "id bigint, x array<double>, label int")


def by_hand(x, q, k):
    d = np.sqrt(((q[:, None, :] - x[None, :, :]) ** 2).sum(2))
    return [(i, r + 1, j) for i in range(len(q)) for r, j in enumerate(sorted(range(len(x)), key=lambda j: (d[i, j], j))[:k])]


def rows(found):
    return [(r["id"], r["rank"], r["neighbour"]) for r in found.orderBy("id", "rank").collect()]


def test_tables_find_nine_tenths(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 24)) + 2 * rng.normal(size=(40, 24))[rng.integers(0, 40, 4000)]
    df = table(spark, x)
    asked = df.filter("id % 20 = 0")
    model = neighbours.fit_hash_tables(df, "id", "x", "label", bits=6)
    found = neighbours.approximate_neighbours(model, asked, "id", "x", 5)
    exact = neighbours.neighbours(neighbours.fit_neighbours(df, "id", "x", "label"), asked, "id", "x")
    got = neighbours.recall(found, exact, "id").first()
    assert got["n_wanted"] == 1000 and got["recall"] >= 0.9
    few = neighbours.recall(neighbours.approximate_neighbours(neighbours.fit_hash_tables(df, "id", "x", "label", tables=1, bits=6), asked, "id", "x", 5, 1), exact, "id")
    assert few.first()["recall"] < got["recall"]


@pytest.mark.parametrize("block", [50, 10_000])
def test_a_third_of_all_rows_in_one_bucket(spark, block):
    rng = np.random.default_rng(4)
    x = np.concatenate([np.ones((300, 4)), rng.normal(size=(600, 4)) * 3])
    df = table(spark, x)
    asked = table(spark, np.concatenate([np.ones((60, 4)), x[300:320] + 0.01]))
    q = np.concatenate([np.ones((60, 4)), x[300:320] + 0.01])
    model = neighbours.fit_hash_tables(df, "id", "x", "label", bits=3, block=block)
    got = neighbours.approximate_neighbours(model, asked, "id", "x", 4)
    assert rows(got)[:240] == by_hand(x, q, 4)[:240]  # of equal distances the first ids
    plan = model.table.groupBy("_table", "_bucket").count().agg({"count": "max"}).first()[0]
    assert plan >= 300
    exact = neighbours.fit_neighbours(df, "id", "x", "label", 4, 8, block)
    assert rows(neighbours.neighbours(exact, asked, "id", "x")) == by_hand(x, q, 4)


def test_fewer_rows_than_wanted(spark):
    df = table(spark, [[0.0, 1.0], [2.0, 2.0]])
    exact = neighbours.neighbours(neighbours.fit_neighbours(df, "id", "x", "label", 5), df, "id", "x")
    near = neighbours.approximate_neighbours(neighbours.fit_hash_tables(df, "id", "x", "label"), df, "id", "x", 5)
    assert rows(exact) == rows(near) == [(0, 1, 0), (0, 2, 1), (1, 1, 1), (1, 2, 0)]
    with pytest.raises(ValueError, match="no training rows"):
        neighbours.fit_hash_tables(df.limit(0), "id", "x", "label")


def test_small_cells_look_beyond_themselves(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(3, 2)) + 50, rng.normal(size=(80, 2))])
    q = rng.normal(size=(20, 2)) + 50
    model = neighbours.fit_neighbours(table(spark, x), "id", "x", "label", 6, 20)
    assert rows(neighbours.neighbours(model, table(spark, q), "id", "x")) == by_hand(x, q, 6)


def test_vectors_are_not_written_for_each_cell(spark, monkeypatch):
    """In many dimensions every query has to look at nearly every cell."""
    x = np.random.default_rng(9).normal(size=(1500, 24))
    df, written = table(spark, x), []

    def counted(made, name, plain=neighbours.materialise):
        out = plain(made, name)
        written.append(out.count() if "_x" in out.columns else 0)
        return out
    monkeypatch.setattr(neighbours, "materialise", counted)
    got = neighbours.neighbours(neighbours.fit_neighbours(df, "id", "x", "label", 3, block=100), df, "id", "x")
    assert rows(got) == by_hand(x, x, 3)
    assert sum(written) <= 3 * len(x)


def test_names_as_ids_over_many_parts(spark):
    """Ids that sort as text, labels with gaps, single precision, equal distances in other cells, a query that comes twice."""
    x = np.concatenate([np.repeat(np.arange(12.0), 10)[:, None] * [1, 0], np.repeat(np.arange(12.0), 10)[:, None] * [1, 0] + [0, 1]])
    names = [f"n{i}" for i in range(len(x))]
    df = spark.createDataFrame([(n, v.tolist(), i if i % 7 else None) for i, (n, v) in enumerate(zip(names, x))], "id string, x array<float>, label int")
    q = [[3.5, 0.5], [3.5, 0.5], [0.0, 0.0], [20.0, 20.0]]
    asked = spark.createDataFrame([(f"q{i // 2 if i < 2 else i}", v) for i, v in enumerate(q)], "id string, x array<double>")
    model = neighbours.fit_neighbours(df, "id", "x", "label", 25, 20, 5)
    got = [(r["id"], r["neighbour"], r["label"]) for r in neighbours.neighbours(model, asked, "id", "x").orderBy("id", "rank").collect()]

    def near(v):
        d = np.sqrt(((x - v) ** 2).sum(1))
        best = sorted(range(len(x)), key=lambda j: (d[j], names[j]))
        return [(names[j], j if j % 7 else None) for j in best[:25]]
    assert [g[1:] for g in got if g[0] == "q2"] == near(q[2]) and [g[1:] for g in got if g[0] == "q3"] == near(q[3])
    assert [g[1:] for g in got if g[0] == "q0"] == [n for n in near(q[0])[:13] for _ in range(2)][:25]
