"""Shapes of field values: exact keys, numbers that are no truth values, and the evidence that a value needs."""

import pytest

from ledgerleaf.operators.conversion import value_problems

AMOUNT = {"amount": 1.0, "unit": "%"}
LOAD = {"rate": AMOUNT, "basis": None, "condition": "x", "text": "1%"}
CLASS = {"class_name": "A", "front_load": LOAD, "back_load": None, "total_fee": AMOUNT, "peer_total_fee": None}
TIER = {"period": "90", "basis": None, "rate": AMOUNT, "applies_to": ["A"]}


@pytest.mark.parametrize(
    ("field", "value", "evidence", "right"),
    [
        ("fee_structure", {"classes": [CLASS]}, 3, True),
        ("fee_structure", {"classes": []}, 1, False),
        ("fee_structure", {"classes": [CLASS], "more": 1}, 1, False),
        ("fee_structure", {"classes": [CLASS | {"total_fee": {"amount": True, "unit": "%"}}]}, 1, False),
        ("fee_structure", {"classes": [CLASS | {"front_load": LOAD | {"basis": 1}}]}, 1, False),
        ("fee_structure", {"classes": [{k: v for k, v in CLASS.items() if k != "back_load"}]}, 1, False),
        ("redemption_terms", {"tiers": []}, 0, True),
        ("redemption_terms", {"tiers": [TIER]}, 1, True),
        ("redemption_terms", {"tiers": [TIER | {"applies_to": []}]}, 1, False),
        ("redemption_terms", {"tiers": [TIER | {"period": None}]}, 1, False),
        ("key_risk_phrases", ["a", "b"], 2, True),
        ("key_risk_phrases", ["a", "b"], 1, False),
        ("key_risk_phrases", list("abcdef"), 6, False),
        ("principal_loss_notice", "x", 1, True),
        ("principal_loss_notice", "", 1, False),
        ("principal_loss_notice", "x", 2, False),
        ("other", "x", 1, False),
    ],
)
def test_shapes(field, value, evidence, right):
    assert (value_problems(field, value, evidence) == []) == right
