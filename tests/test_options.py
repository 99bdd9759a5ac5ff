import pytest

from sectorgauge import Settings, __main__

NEEDED = ["measures", "--source", "s", "--target", "t", "--as-of", "2026-06-15"]


def settings_of(*options):
    return __main__.settings_of(__main__.parser().parse_args([*NEEDED, *options]))


def test_limits_keep_their_defaults_unless_given():
    given = settings_of()
    assert given == Settings(as_of=given.as_of)


def test_limits_can_be_moved_and_lifted():
    given = settings_of(
        "--entry-from", "2000-01-01", "--entry-before", "2027-01-01", "--kpi-start", "2015-03",
        "--element-start", "2018-12", "--fin-year-max", "2026",
    )
    assert (given.entry_from, given.entry_before) == ("2000-01-01", "2027-01-01")
    assert (given.kpi_start, given.element_start, given.fin_year_max) == ("2015-03", "2018-12", 2026)
    assert settings_of("--fin-year-max", "none").fin_year_max is None


@pytest.mark.parametrize("bad", [("--entry-before", "2027"), ("--kpi-start", "2015-13")])
def test_limits_refuse_what_is_no_date(bad):
    with pytest.raises(SystemExit):
        settings_of(*bad)
