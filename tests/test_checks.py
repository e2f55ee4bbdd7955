from medallion.plans import checks
from medallion.plans.models import LAYERS, MODELS


def test_declared_test_counts():
    unique_and_not_null = sum(len(v) for v in checks.KEYED.values()) * 2
    relationships = sum(len(v) for v in checks.RELATIONSHIPS.values())
    assert unique_and_not_null == 26 and relationships == 19
    assert sum(len(v) for v in checks.DUPLICATE_GRAIN.values()) == 16


def test_gold_sensor_parameter_is_deliberately_untested():
    # a gold sensor may point to a parameter filtered out of gold (no data)
    assert ("sensor", "parameter_id", "parameter", "id") not in checks.RELATIONSHIPS["gold"]
    assert ("sensor", "parameter_id", "parameter", "id") in checks.RELATIONSHIPS["silver"]


def test_eighteen_models_in_three_layers():
    assert len(MODELS) == 18
    assert [m.layer for m in MODELS] == sorted((m.layer for m in MODELS), key=LAYERS.index)
