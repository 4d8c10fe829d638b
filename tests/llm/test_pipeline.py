from collections import Counter, defaultdict

from catalog_lineage.llm import decontamination, neardup, toxicity
from catalog_lineage.llm.common import table
import corpus_pipeline
from tests.llm.test_mixing import waterfill

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.train(docs, table(spark, SF, "labels"))
    scores = {r.doc_id: r.toxicity.score for r in toxicity.score_texts(docs, model).collect()}
    gentle = {i: rows[i].text for i in rows if scores[i] < toxicity.REJECT}
    df = docs.where(docs.doc_id.isin(list(gentle)))
    classes = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    unique = [i for i in gentle if classes[i] == i]
    items = [(r.item_id, decontamination.normal(r.text)) for r in table(spark, SF, "benchmark").collect()]
    matcher = decontamination.Matcher(items, decontamination.EDIT_RATE)
    clean = [i for i in unique if not matcher.matches(rows[i].text)]

    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} <= set(clean)
    size, taken, sizes = lambda t: len(t.split()), defaultdict(int), defaultdict(int)
    for i in clean:
        sizes[rows[i].source] += size(rows[i].text)
    for r in out:
        taken[r.source] += size(r.text)
        assert rows[r.doc_id].text.startswith(r.text) and r.n_chars == len(r.text)
    targets = waterfill(sizes, {s: k % 3 + 1 for k, s in enumerate(sorted(sizes))})
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    assert max(Counter(r.doc_id for r in out).values()) <= 3
    shards = Counter(r.shard for r in out)
    assert max(shards.values()) - min(shards.get(k, 0) for k in range(40)) <= 1


def test_shape():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mix", "shard"]
