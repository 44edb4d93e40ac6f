"""Which of several rows with one id are drawn does not depend on partitions."""

from ticketgrain.operators import sampling


def test_ties_at_the_cut(spark):
    rows = [(1 + k // 50, k % 50, {"k": k}) for k in range(100)]
    drawn = set()
    for parts, order in ((1, rows), (4, rows[::-1]), (7, rows[50:] + rows[:50])):
        df = spark.createDataFrame(order, "id long, place int, props map<string,int>").repartition(parts)
        for pick in (sampling.random_sample(df, 60, "id"), sampling.head(df, 60, "id")):
            drawn.add(tuple(sorted((r.id, r.place) for r in pick.collect())))
    heads = {tuple((1 if first else 2, k) for first in (True,) for k in range(50)) + tuple((2, k) for k in range(10))}
    assert len(drawn) <= 2 and heads <= drawn
    assert all([p for i, p in pick].count(0) == 2 and len(pick) == 60 for pick in drawn)
