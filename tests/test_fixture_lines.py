"""Fixtures keep every line of an order."""

import pytest

import bibspark.fixture_more  # noqa: F401  (registers fx_more and fx_all)
from bibspark.fixtures import with_fixtures


@pytest.mark.parametrize("tags", ["'490'", "'650', '651', '655'", "'700'", "'541', '561'", "'051'", "'382'", "'600'", "'852'"])
def test_every_line_gives_a_field(duck, tags):
    fields = with_fixtures(f"SELECT count(*) FROM (SELECT DISTINCT record_id, ord, tag FROM fx_all WHERE tag IN ({tags}))")
    lines = with_fixtures("SELECT count(*) FROM fx_lines")
    assert duck.execute(fields).fetchone() == duck.execute(lines).fetchone() != (0,)


def test_fields_have_places_of_their_own(duck):
    twice = with_fixtures("SELECT record_id, ord FROM fx_all GROUP BY record_id, ord HAVING count(DISTINCT tag) > 1")
    assert duck.execute(twice).fetchall() == []
