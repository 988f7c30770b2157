from __future__ import annotations

from llm_cases import prose

from starloom.llm import quality_rules, toxicity


def test_a_repeated_id_is_one_labelled_row(spark, documents, monkeypatch):
    rows = [(i, prose(i, 40)) for i in range(30)]
    docs = documents([*rows, *((3, prose(500 + k, 40)) for k in range(50)), *[rows[4]] * 50])
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(30)], "doc_id long, quality int, toxic int")
    sizes = []

    def cover(values, bad, inner=quality_rules.cover, **settings):
        sizes.append(len(bad))
        return inner(values, bad, **settings)

    def label_model(votes, balance, inner=toxicity.label_model):
        sizes.append(len(votes))
        assert balance == 0.5
        return inner(votes, balance)

    monkeypatch.setattr(quality_rules, "cover", cover)
    monkeypatch.setattr(toxicity, "label_model", label_model)
    quality_rules.learn_rules(docs, labels)
    toxicity.learn_toxicity(docs, labels)
    assert sizes == [30, 30]
