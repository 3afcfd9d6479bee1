"""Raw tables end to end, with the edge values of the input descriptions."""

import pytest
from pyspark.sql import functions as F

from signalmill import schemas
from signalmill.operators import cells, feed
from signalmill.plans import transforms


def frame(spark, columns, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ", ".join(f"`{c}` string" for c in columns) + ", row_idx long")


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def facilities(spark):
    row = lambda i, kind, status, mw, lat, lon: (i, f"N{i}", "Op", kind, status, mw, "1,000", "", "n/a", "", "", "VA", "", lat, lon)
    return frame(spark, list(schemas.FACILITY), [row("a", '["Miner"]', '["Planned","Under Construction"]', "240,549", "38.5", "-75"), row("b", "", "[]", "5d", "0", "0"), row("c", "[]", "Planned", "", "0", "-75"), row("d", None, '["Odd"]', "7", "38.5", "-75.0")])


def sheet(spark, rows):
    return frame(spark, list(schemas.GENERATOR), rows)


def test_facilities(spark):
    got = transforms.facility_points(facilities(spark))
    assert values(got, "asset_id", "company_type", "status", "estimated_mw", "total_sqft", "power_cap_mw") == [
        ("a", "Miner", "Planned", 240549.0, 1000.0, 0.0), ("c", "Unclassified", "Planned", 0.0, 1000.0, 0.0), ("d", "Unclassified", "Unknown", 7.0, 1000.0, 0.0),
    ]
    with pytest.raises(ValueError):
        transforms.facility_points(facilities(spark).drop("Status"))


def plants(spark):
    g = lambda p, mw, tech, lat, lon, status="OP": (p, f"P{p}", "VA", "c", mw, tech, status, lat, lon)
    operating = sheet(spark, [g("1", "5", "Nuclear", "0", "-75"), g("1", "5", "Onshore Wind Turbine", "38", "0", "SB"), g("", "9", "x", "1", "1"), g("2", "x", "Odd", "0", "0"), g("3", "1", "Nuclear", "", "")])
    return transforms.plant_points(operating, sheet(spark, [g("1", "9", "Nuclear", "1", "1"), g("4", "2", "Batteries", "40", "-80")]))


def test_rows_without_their_order_are_refused(spark):
    with pytest.raises(ValueError):
        transforms.generator_table(sheet(spark, [("1", "P", "VA", "c", "5", "Nuclear", "OP", "0", "-75")]).drop("row_idx"))


def test_plants(spark):
    assert values(plants(spark), "plant_id", "nameplate_mw", "generator_count", "lat", "lon", "tech_group", "pp_status", "eia_statuses") == [
        ("1", 10.0, 2, 38.0, -75.0, "Nuclear", "Operational", "OP, SB"), ("3", 1.0, 1, None, None, "Nuclear", "Operational", "OP"), ("4", 2.0, 1, 40.0, -80.0, "Other/Storage", "Planned", "OP"),
    ]


def test_feed_and_links(spark):
    row = lambda i, date, states, ids, dup, s, r: (i, f"T{i}", "u", "s", date, "sum", "cat", "A; B", states, ids, dup, "", s, r, "True", "")
    raw = frame(spark, schemas.NEWS_FEED, [
        row("1", "01/26/2026 07:08 PM", '["VA","xx"]', "", "False", "4", "5"), row("2", "1/25/2026", "[]", '["DC-1"," ","DC-1"]', " true ", "4.0", "x"),
        row("3", "bad", " va , PA", "", "", "", "3"), row("4", "2026-01-20", "[null]", "DC-2", "False", "5", "4"),
    ])
    typed = transforms.typed_feed(raw)
    assert values(typed, "id", "strategy", "relevance", "is_duplicate", "tagged") == [("1", 4, 5, False, False), ("2", 4, 0, True, True), ("3", 0, 3, False, False), ("4", 5, 4, False, True)]
    assert values(transforms.facility_links(typed), "id", "dc_id") == [("2", "DC-1"), ("2", "DC-1"), ("4", "DC-2")]
    assert values(transforms.state_links(typed), "id", "state") == [("1", "VA"), ("3", "PA"), ("3", "VA")]
    assert values(feed.tagged_stories(typed, "2026-01-26"), "id", "score") == [("4", 9)]
    assert values(feed.other_stories(typed, "2026-01-26"), "id") == [("1",)]


def test_features(spark):
    soil = frame(spark, list(schemas.SOIL), [("6-1030-839", "rock", None, "5.1", "99.9"), ("6-1028-840", "Rock", "10", "5.0", "0"), ("6-900-500", None, "nan", None, "300")])
    costs = transforms.soil_costs(soil)
    assert [round(c, 4) for _, c in values(costs, "cell", "unit_cost_ft")] == [round(23 * 1.0812310390375761 * 1.18 * 1.2, 4), round(70 * 1.0812310390375761 * 1.2 * 1.002, 4), round(23 * 1.0812310390375761 * 0.92, 4)]
    got = transforms.cell_features(transforms.facility_points(facilities(spark)), plants(spark), cells.parent_cost(costs))
    assert {r["resolution"] for r in got.collect()} == {3, 4, 5}
    three = {r["cell"]: r for r in got.where("resolution = 3").collect()}
    # facilities at 38.5, -75 and 0, -75; plants at 38, -75 (one cell with the facilities) and 40, -80
    assert three["3-128-105"]["dc_total_mw"] == 240556.0 and three["3-128-105"]["pp_total_mw"] == 10.0 and three["3-128-105"]["dc_total_pct"] == 1.0
    assert three["3-90-105"]["is_zero"] and three["3-90-105"]["dc_total_pct"] == 0.0 and three["3-130-100"]["dc_total_pct"] is None
    assert all(r["bc_unit_cost_ft"] is not None for r in three.values())
    assert got.select(F.max(cells.composite({"dc_total_pct": 50, "pp_total_pct": 30, "bc_pct": 20}))).first()[0] <= 1
