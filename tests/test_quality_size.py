"""Evidence is read once for the quality counts, and its sources are counted before they meet the objects."""

from unittest import mock

from catalog_lineage.operators import quality


def test_sources_of_evidence_are_counted_first(spark):
    frame = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    objects = frame("object_id string, object_type string, object_name string", ("a", "CUBE", "A"))
    edges = frame("relationship_id string, source_object_id string, target_object_id string, source_qualified_name string, target_qualified_name string", ("r", "a", "a", "A", "A"))
    evidence = frame("source_object_id string, target_expression string", *[("a", "x"), ("b", " "), ("b", "y"), (None, None), (" a ", "x")] * 20)
    vals, warnings = frame("relationship_id string, validation_status string", ("r", "VALID")), frame("w string", ("w",))
    judged, unmatched = frame("disposition string", ("ACCEPTED",)), frame("exception_id string", ("x",))
    written, real = [], quality.cut
    with mock.patch.object(quality, "cut", side_effect=lambda df: written.append(df.count()) or real(df)):
        row = quality.quality_counts(objects, edges, evidence, vals, warnings, judged, unmatched).first()
        none = quality.quality_counts(objects, edges, evidence.limit(0), vals, warnings, judged, unmatched).first()
    assert written == [4, 0] and (row.evidence, row.blank_evidence_targets, row.orphan_evidence_sources) == (100, 40, 60)
    assert (none.evidence, none.blank_evidence_targets, none.orphan_evidence_sources) == (0, 0, 0)
