import corpus_pipeline as C
from tessera.llm import packing, simhash
from tessera.llm.common import persisted, read_table

from llm_cases import SF


def repeated_runs(rows, words=50):
    """Runs of fifty words, of C.REPEAT bytes or more (not "la la la"), that stand in more than one place."""
    seen, twice = set(), set()
    for r in rows:
        w = (r["text"] or "").split()
        for i in range(len(w) - words + 1):
            run = " ".join(w[i:i + words])
            if len(run.encode()) >= C.REPEAT:
                (twice if run in seen else seen).add(run)
    return twice


def test_stages_work_on_what_the_one_before_kept(spark):
    assert [name for name, _ in C.STAGES] == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "mix_sources", "pack"]
    docs = read_table(spark, SF, "documents")
    columns, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    kept = []
    for name, stage in C.STAGES[:-1]:
        docs = persisted(stage(spark, docs, SF), name)
        assert docs.columns == columns, name
        kept.append(docs.collect())
    language, near, cut, mixed = kept
    assert len(language) >= 0.95 * len(before) and all(before[r["doc_id"]] == r for r in language)
    groups = simhash.near_duplicate_documents(read_table(spark, SF, "documents")).collect()
    assert sorted(r["doc_id"] for r in near) == sorted({r["component_id"] for r in groups} & {r["doc_id"] for r in language}) \
        or len(language) < len(before)
    assert sorted(r["doc_id"] for r in cut) == sorted(r["doc_id"] for r in near)
    assert sum(len(r["text"]) for r in cut) < sum(len(r["text"]) for r in near) and all(len(r["text"]) == r["n_chars"] for r in cut)
    text = {r["doc_id"]: r["text"] for r in cut}
    assert all(text[r["doc_id"]] == r["text"] for r in mixed)
    assert repeated_runs(near) and not repeated_runs(cut)
    assert max(sum(1 for r in mixed if r["doc_id"] == i) for i in text) <= 2
    out = C.run(spark, SF)
    assert out.columns == packing.pack(docs).columns
    encode = packing.bpe_encoder()
    assert sum(r["length"] for r in out.collect()) == sum(len(encode(r["text"])) + 1 for r in mixed)


def test_odd_and_empty_tables(spark, odd, none):
    for start in (odd, none):
        docs = start
        for name, stage in C.STAGES[:-1]:
            docs = persisted(stage(spark, docs, SF), name)
            assert docs.columns == start.columns, name
        C.STAGES[-1][1](spark, docs, SF).collect()
