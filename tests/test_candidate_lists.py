from catalog_lineage.operators import resolve

NAMES = ("cube_name", "dimension_name", "hierarchy_name", "attribute_name", "subset_name", "view_name")


def references(spark, rows):
    made = [(i, domain, kind, "t", *[fields.get(n, "") for n in NAMES]) for i, (domain, kind, fields) in enumerate(rows)]
    return spark.createDataFrame(made, ["ref_key", "domain", "relationship_type", "target_name", *NAMES])


def test_every_candidate_of_every_reference_is_listed(spark):
    catalog = [("d", "d", "x"), ("d", "h", "x"), ("d", "h", "x"), ("e", "h", "x"), ("e", "i", "x"), ("e", "i", "z")]
    candidates = spark.createDataFrame(
        [("SUBSET", f"subset::{d}::{h}::{n}", d, h, n, d == h) for d, h, n in catalog],
        "domain string, node_id string, parent_key string, hierarchy_key string, own_key string, is_default boolean")
    refs = references(spark, [
        ("SUBSET", "READS", {"subset_name": "x"}), ("SUBSET", "READS", {"dimension_name": "d", "subset_name": "X"}), ("SUBSET", "READS", {"dimension_name": "e", "subset_name": "x"}),
        ("SUBSET", "READS", {"dimension_name": "d", "hierarchy_name": "h", "subset_name": "x"}), ("SUBSET", "READS", {"subset_name": "none"}), ("SUBSET", "READS", {"subset_name": "sVar"}),
    ])
    matched = resolve.match_candidates(refs, candidates)
    for chunk_rows in (100, 2):
        lists = resolve.candidate_lists(matched, candidates, chunk_rows)
        named = matched.join(lists, ["domain", "candidate_level", "candidate_key"], "left").orderBy("ref_key", "chunk").collect()
        got = {}
        for r in named:
            got.setdefault((r.ref_key, r.match_classification, r.candidate_count), []).extend(r.candidate_node_ids or [])
        of = lambda *at: sorted("::".join(("subset", *catalog[i])) for i in at)
        assert got == {
            (0, "AMBIGUOUS_MATCH", 5): of(0, 1, 2, 3, 4), (1, "DEFAULT_HIERARCHY_MATCH", 1): of(0), (2, "AMBIGUOUS_MATCH", 2): of(3, 4),
            (3, "TARGET_NOT_IN_CATALOG", 2): of(1, 2), (4, "TARGET_NOT_IN_CATALOG", 0): [], (5, "DYNAMIC_REFERENCE", 0): [],
        }
        assert all(len(r.candidate_node_ids) <= chunk_rows for r in lists.collect())
        assert lists.where("candidate_key = 'z'").isEmpty()
