"""The Spark stand-in tables equal their SQL twins row for row."""

from __future__ import annotations

import pytest

from dockmart.sources import standin as S
from dockmart.sources import standin_sql as Q
from harness import compare

BUILDERS = {
    "load_3g": lambda t3, ta, sp, sf: t3.load,
    "stop_3g": lambda t3, ta, sp, sf: t3.stop,
    "loc_3g": lambda t3, ta, sp, sf: t3.loc,
    "partner_3g": lambda t3, ta, sp, sf: t3.partner,
    "mode_3g": lambda t3, ta, sp, sf: t3.mode,
    "load_client_3g": lambda t3, ta, sp, sf: t3.load_client,
    "load_order_3g": lambda t3, ta, sp, sf: t3.load_order,
    "order_header_3g": lambda t3, ta, sp, sf: t3.order_header,
    "order_leg_3g": lambda t3, ta, sp, sf: t3.order_leg,
    "order_leg_load_3g": lambda t3, ta, sp, sf: t3.order_leg_load,
    "load_alms": lambda t3, ta, sp, sf: ta.loads,
    "leg_alms": lambda t3, ta, sp, sf: ta.legs,
    "leg_stop_alms": lambda t3, ta, sp, sf: ta.stops,
    "location_alms": lambda t3, ta, sp, sf: ta.locations,
    "event_stops": lambda t3, ta, sp, sf: S.event_stops(sp, sf),
}


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_standin_matches_sql(spark, sf_dir, duck_small, name):
    t3, ta = S.tables_3g(spark, sf_dir), S.tables_alms(spark, sf_dir)
    df = BUILDERS[name](t3, ta, spark, sf_dir)
    problems = compare(df, duck_small, Q.with_standins(name) + f" SELECT * FROM {name}")
    assert not problems, problems


def test_standin_keeps_every_row(spark, sf_dir):
    li = S.read(spark, sf_dir, "lineitem").count()
    assert S.tables_alms(spark, sf_dir).stops.count() == li
    assert S.tables_3g(spark, sf_dir).stop.count() == li
