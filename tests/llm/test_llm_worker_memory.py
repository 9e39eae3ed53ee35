"""What operators keep in worker processes does not add up over the stages of a pipeline."""

from haulier.llm import common, token_alignment, tokens, toxicity


def test_a_worker_keeps_the_memory_of_one_module(monkeypatch):
    monkeypatch.setattr(common, "_KEPT", [])
    monkeypatch.setattr(common, "_LAST", [])
    scorers, encoders = common.worker_memory(), common.worker_memory()
    common._begin("toxicity")
    scorers[1] = "scorer"
    common._begin("toxicity")
    assert scorers == {1: "scorer"}
    common._begin("packing")
    encoders["path"] = "encoder"
    assert not scorers
    common._begin("packing")
    assert encoders == {"path": "encoder"}


def test_operators_keep_nothing_elsewhere():
    kept = [id(x) for x in common._KEPT]
    assert all(id(x) in kept for x in (toxicity._SCORERS, tokens._ENCODERS, token_alignment._ALIGNERS))
