"""Consistency of the 21 silver table definitions."""

from strata.plans.gold import GOLD_INPUTS
from strata.plans.specs import BY_NAME, SPLIT_DATE_COLUMNS, TABLES

KINDS = {"bigint", "double", "string", "timestamp", "number_text", "empty", "parsed"}


def test_twenty_one_tables_unique():
    assert len(TABLES) == 21
    assert len({t.name for t in TABLES}) == 21 and len({t.bronze_file for t in TABLES}) == 21


def test_columns_kinds_keys_and_policies():
    for t in TABLES:
        cols = t.cols
        assert {c.kind for c in cols} <= KINDS, t.name
        silver = {c.silver for c in cols if c.kind not in ("empty", "parsed")}
        assert len(silver) == len([c for c in cols if c.kind not in ("empty", "parsed")]), t.name
        assert t.silver_key in silver, t.name
        assert set(t.expected_nulls) <= silver, t.name
        assert set(t.required_columns) <= silver, t.name
        assert not set(t.expected_nulls) & set(t.required_columns), t.name
        assert t.domain in ("sales", "purchasing", "dimensions"), t.name


def test_gold_inputs_exist():
    for gold, inputs in GOLD_INPUTS.items():
        assert set(inputs) <= set(BY_NAME), gold


def test_split_tables_have_their_date_column():
    stems = {t.bronze_file[:-4]: t for t in TABLES}
    for stem, col in SPLIT_DATE_COLUMNS.items():
        assert col in {c.bronze for c in stems[stem].cols}, stem
