"""A store of partial tables makes the tables that its readers need, and no others."""

import pytest

from tallyscope.operators import partials as pt
from tallyscope.settings import Thresholds
from tallyscope.sources import fixtures as fx
from tests.conftest import DATA


def test_a_store_makes_only_the_tables_it_was_given(spark, tmp_path):
    rounds = fx.rounds_from_events(spark, DATA)
    store = pt.PartialStore(spark, str(tmp_path), Thresholds(), pt.OF_CELLS)
    assert store.advance(rounds, "2024-01-10")
    assert {e["table"] for e in store.table.version().entries} == {"cells"}
    p = store.asof(rounds, "2024-01-12 12:00:00")
    assert set(p.held()) == {"cells"}
    assert pt.game_day(p).agg({"rounds": "sum"}).first()[0] == rounds.where("game_time <= '2024-01-12 12:00:00'").count()
    with pytest.raises(ValueError):
        pt.PartialStore(spark, str(tmp_path)).asof(rounds, "2024-01-12 12:00:00")
