"""Header metadata rules (R1-R5, R12-R16) — pure Python, no Spark."""
import pytest

from keystitch.plans.headers import (
    NoKeyColumns, detect_keys, key_sources, missing_targets, output_names, plan_layout, resolve_headers,
)
from keystitch.sources.csv import header_names, kept_positions, parse_header
from keystitch.spec import DEFAULT_ALIASES, EnrichSpec


def test_r1_exact_before_case_insensitive():
    cols = ["sector", "Sector"]
    assert resolve_headers(cols, [("Sector", "Travel_Sector")]) == {"Sector": "Travel_Sector"}


def test_r1_case_insensitive_first_in_file_order():
    cols = ["x", " SECTOR ", "sector"]
    assert resolve_headers(cols, [("Sector", "Travel_Sector")]) == {" SECTOR ": "Travel_Sector"}


def test_r1_trims_python_whitespace():
    assert resolve_headers([" Airline Code\t"], DEFAULT_ALIASES) == {" Airline Code\t": "Airline_Code"}


def test_r2_last_target_wins_first_position_kept():
    m = resolve_headers(["A", "b"], [("a", "X"), ("b", "Y"), ("A", "Z")])
    assert list(m.items()) == [("A", "Z"), ("b", "Y")]


def test_r3_first_alias_even_if_empty_and_r4_alias_beats_canonical():
    cols = ["PNR_Number", "Airline PNR", "pnrnumber"]
    m = resolve_headers(cols, DEFAULT_ALIASES)
    assert key_sources(["PNR_Number"], m) == [["Airline PNR"]]
    assert key_sources(["PNR_Number"], m, coalesce=True) == [["Airline PNR", "pnrnumber"]]
    assert key_sources(["Airline_Code"], m) == [["Airline_Code"]]


def test_r5_first_complete_combination_exact_case():
    combos = [("A", "B"), ("A",)]
    assert detect_keys(["A"], {}, combos) == ("A",)
    with pytest.raises(NoKeyColumns):
        detect_keys(["a"], {}, combos)


def test_r12_r14_missing_targets_in_fixed_order():
    targets = EnrichSpec().targets
    miss = missing_targets(["Invoice_Number", "Cgst_Total"], targets)
    assert [m[0] for m in miss][:3] == ["Taxable_Amount", "NonTaxable_Amount", "Sgst_Total"]
    assert "Cgst_Total" not in [m[0] for m in miss]


def test_r13_passthrough_plan():
    spec = EnrichSpec()
    cols = ["Airline PNR", "Airline Code", "Sector"] + spec.target_columns
    assert plan_layout(cols, spec).passthrough


def test_r16_display_name_collision_gets_suffix():
    assert output_names(["CGST"], [("Cgst_Total", "CGST"), ("Booking_Date", "Booking Date")]) == [
        "CGST__ref", "Booking Date"]


def test_csv_header_labels_blank_and_duplicates():
    assert header_names(["a", "", "a", "a.1", "a"]) == ["a", "Unnamed: 1", "a.2", "a.1", "a.3"]
    assert header_names(["a", "a", "a.1"]) == ["a", "a.2", "a.1"]
    assert kept_positions(header_names(["a", "", "b"])) == [0, 2]
    assert parse_header('"x,y",z,"q""r"') == ["x,y", "z", 'q"r']


def test_spec_from_dict_keeps_alias_order():
    cfg = {"column_mapping": {"b": "K", "a": "K"}, "possible_reference_combinations": [["K"]],
           "targets": ["T1", {"column": "T2", "display": "T two"}]}
    s = EnrichSpec.from_dict(cfg)
    assert s.aliases == (("b", "K"), ("a", "K"))
    assert s.targets == (("T1", "T1"), ("T2", "T two"))
