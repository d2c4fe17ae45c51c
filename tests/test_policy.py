from __future__ import annotations

import pytest

from rentledger.operators import policy
from rentledger.plans.recipes import principal_access
from tests.fixtures import bag, values


def test_principal_sees_own_rows_only(shop):
    rental, customer = shop["rental"], shop["customer"]
    seen = policy.visible_rows(rental, customer, "client_KAY_O_HARA")
    assert {r.customer_id for r in seen.collect()} == {3} and seen.count() == 43
    assert policy.policy_leaks(seen, customer, "client_KAY_O_HARA").count() == 0
    assert policy.policy_leaks(rental, customer, "client_KAY_O_HARA").count() == 85


def test_unknown_principal_sees_nothing(shop):
    assert policy.visible_rows(shop["rental"], shop["customer"], "client_NO_ONE").count() == 0
    assert policy.policy_leaks(shop["rental"], shop["customer"], "client_NO_ONE").count() == 0


def test_shared_name_is_an_error(shop):
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        policy.visible_rows(shop["rental"], shop["customer"], "client_TWIN_NAME").collect()


def test_raw_names(shop):
    rental, customer = shop["rental"], shop["customer"]
    assert policy.visible_rows(rental, customer, "client_KAY_O_HARA", raw=True).count() == 0
    assert policy.visible_rows(rental, customer, "client_Kay_O'Hara", raw=True).count() == 43
    both = policy.visible_rows(rental, customer, "client_JAN_FOY", raw=True)
    assert bag(both) == bag(policy.visible_rows(rental, customer, "client_JAN_FOY"))


def test_first_active(shop):
    facts = [(shop["rental"], "customer_id"), (shop["payment"], "customer_id")]
    assert [r[0] for r in values(policy.first_active(shop["customer"].where("customer_id > 1"), "customer_id", facts))] == [2]


def test_access_report(shop):
    facts = {"rental": shop["rental"], "payment": shop["payment"]}
    assert bag(principal_access(shop["customer"], facts, "client_JAN_FOY")) == [("payment", 43, 0), ("rental", 43, 0)]


def test_policy_is_a_pushed_filter(shop, tmp_path):
    path = str(tmp_path / "rental")
    shop["rental"].write.parquet(path)
    stored = shop["rental"].sparkSession.read.parquet(path)
    plan = policy.visible_rows(stored, shop["customer"], "client_JAN_FOY")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(customer_id), EqualTo(customer_id,ScalarSubquery" in plan
    assert "Join" not in plan
