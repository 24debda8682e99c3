"""Composite queries: what they compute how often."""

from pyspark.sql import functions as F

from casebook.plans import queries as Q

from .conftest import SF_SMALL


def test_clustered_dataset_preprocesses_the_journal_once(spark, monkeypatch):
    made, plain = [], Q.DG.preprocess

    def counted(df, **kwargs):
        made.append(1)
        return plain(df, **kwargs)

    monkeypatch.setattr(Q.DG, "preprocess", counted)
    monkeypatch.setattr(Q.TX, "cluster_notes", lambda vec, docs, doc, **kwargs: docs.withColumn("cluster", F.lit(3)))
    got = Q.q_dataset_e78_clustered(spark, SF_SMALL).groupBy("clusters").count().collect()
    assert len(made) == 1 and 3 in {r["clusters"] for r in got}
