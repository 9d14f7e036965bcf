"""All levels of the hierarchy: chains, trees, several managers, cycles."""
from martflow.operators import hierarchy as H


def team(spark, rows):
    return spark.createDataFrame(rows, "id bigint, manager_id bigint").repartition(3)


def above(rows):
    """Brute force: (member, ancestor) -> smallest level, endless chains left out."""
    ids = {i for i, _ in rows if i is not None}
    up = {i: {m for j, m in rows if j == i and m in ids and m != i} for i in ids}
    out, endless = {}, set()
    for i in up:
        seen, front, level = {}, {i}, 0
        while front and level <= len(up):
            level += 1
            front = {m for x in front for m in up.get(x, ())}
            for m in front:
                seen.setdefault(m, level)
        if front:
            endless.add(i)
        else:
            out.update({(i, m): d for m, d in seen.items()})
    return out, endless


def check(spark, rows):
    want, endless = above(rows)
    got = H.ancestors(team(spark, rows)).collect()
    assert len(got) == len(want) and {(r["member"], r["ancestor"]): r["level"] for r in got} == want
    assert {r["member"] for r in H.cyclic_members(team(spark, rows)).collect()} == endless


def test_chain_and_tree(spark):
    check(spark, [(i, i - 1) for i in range(1, 38)] + [(0, None)])
    check(spark, [(i, i // 3) for i in range(1, 60)])


def test_self_missing_null_and_repeated(spark):
    check(spark, [(1, 1), (2, 1), (2, 1), (3, 99), (4, None), (5, 4), (None, 1), (6, 2), (6, 5), (7, 6), (5, 1)])
    check(spark, [])


def test_cycles_are_found_and_left_out(spark):
    check(spark, [(1, 2), (2, 3), (3, 1), (4, 1), (5, 4), (6, 7), (7, 7), (8, 6)])


def test_rollup_reaches_every_level(spark):
    rows = [(1, None), (2, 1), (3, 2), (4, 3), (5, 1)]
    totals = spark.createDataFrame([(3, 10), (4, 5), (4, 2), (5, 1), (9, 100)], "sales_person_id bigint, total_sales int")
    got = {r["manager_id"]: (r["team_total"], r["members"], r["levels"])
           for r in H.rollup(totals, team(spark, rows)).collect()}
    assert got == {1: (18, 3, 3), 2: (17, 2, 2), 3: (7, 1, 1)}
