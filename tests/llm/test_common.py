from martwell.llm.common import kept_by


def test_a_worker_keeps_what_one_operator_needs():
    kept_by("a")["x"] = 1
    assert kept_by("a") == {"x": 1}
    assert kept_by("b") == {}
    assert kept_by("a") == {}
