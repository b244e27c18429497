"""A wrong label does not loosen a language's limit."""

from ledgerleaf.llm import langid


def test_mislabelled_text_is_left_out():
    words = {"en": "the of and to in that with from they this", "de": "der die und das ist nicht mit von ein auf"}
    models = langid.LanguageModels.train({k: dict.fromkeys(v.split(), 1) for k, v in words.items()})
    right = [("en", "that with from " * 40), ("de", "mit von ein " * 40)]
    models.calibrate(right)
    mean, limit = models.mean.tolist(), models.limit.tolist()
    models.calibrate([*right, ("de", "they this the and " * 40)])
    assert (models.mean.tolist(), models.limit.tolist()) == (mean, limit)
    models.calibrate([right[0], ("de", "they this the and " * 40)])
    assert all(x < float("inf") for x in models.mean)
