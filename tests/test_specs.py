"""The rules of the fact loads, stated once more apart from the specs that the queries are built of."""

import pytest

from tidemark.plans.specs import SPECS, TIERS

# By fact, its key, its event, the columns whose change updates a row, those of them
# where a missing text equals an empty one, and those that dev and test never update.
FACTS = {
    "Budget": (
        "Budget_ID",
        "Last_Modified_Date",
        {"Last_Modified_Date", "Actual_Amount", "Budgeted_Amount", "Approval_Status"},
        {"Approval_Status"},
        set(),
    ),
    "Hr": (
        "HR_ID",
        "Processing_Date",
        {"Processing_Date", "Net_Amount", "Payment_Status", "Hours_Worked"},
        set(),
        {"Hourly_Rate"},
    ),
    "Inventory": (
        "Inventory_ID",
        "Transaction_DateTime",
        {"Transaction_DateTime", "Quantity", "Total_Value", "Is_Verified"},
        set(),
        set(),
    ),
    "Purchases": (
        "Purchase_ID",
        "Transaction_Date",
        {"Transaction_Date", "Total_Amount", "Delivery_Status"},
        set(),
        set(),
    ),
    "Sales": (
        "Sales_ID",
        "Transaction_DateTime",
        {"Transaction_DateTime", "Total_Amount", "Payment_Status"},
        set(),
        set(),
    ),
}
# Facts that test reads from the raw tables, as dev does.
FROM_RAW = {"Budget": "fact_budget", "Hr": "fact_hr", "Inventory": "fact_inventory", "Purchases": "fact_purchases"}


@pytest.mark.parametrize("tier", TIERS)
@pytest.mark.parametrize("table", FACTS)
def test_fact_rules(tier, table):
    key, event, compared, null_safe, kept = FACTS[table]
    spec = SPECS[tier][table]
    # prod shows a space where dev has an underscore.
    plain = lambda names: {n.replace(" ", "_") for n in names}
    assert plain([spec.key, spec.event]) == {key, event}
    assert plain((*spec.compare, *spec.compare_null_safe)) == compared
    assert plain(spec.compare_null_safe) == null_safe
    assert plain(spec.never_updated) == (set() if tier == "prod" else kept)


@pytest.mark.parametrize("table", FACTS)
def test_fact_sources(table):
    raw = FROM_RAW.get(table, "fact_sales")
    assert SPECS["dev"][table].source == raw
    assert SPECS["test"][table].source == ("dev_data.Sales" if table == "Sales" else raw)
    assert SPECS["prod"][table].source == f"test_data.{table}"


def test_facts_are_the_facts():
    for tier in TIERS:
        assert {name for name, spec in SPECS[tier].items() if spec.is_fact} == set(FACTS)
