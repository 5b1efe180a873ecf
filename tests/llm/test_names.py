"""Extra columns named like the operators' own are kept as they were."""

from riskloom.llm import content_sort, host_rules, mixing, simhash_grid

CLASHES = (
    "_cs_key", "_cs_part", "_cs_edge", "_cs_text", "_hr_text", "_hr_host", "_hr_words", "_hr_kept", "_sg_id", "_sg_hash", "_mx_copies", "_mx_copy", "_mx_source",
    "id", "size", "before", "mix_key", "target", "source_size", "fp", "component", "w", "c0", "c1",
)


def test_clashing_columns_are_kept(spark):
    words = " ".join(f"word{k}" for k in range(60))
    rows = [(1, words, "a"), (2, words, "a"), (3, words.replace("word7", "other"), "b"), (4, None, None)]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` long" for c in CLASHES)
    frame = spark.createDataFrame([(*r, *(100 * r[0] + k for k in range(len(CLASHES)))) for r in rows], schema)
    for run in (content_sort.drop_copies, host_rules.passing, simhash_grid.drop_near_copies, mixing.drawn):
        out = run(frame)
        assert out.columns == frame.columns
        got = out.collect()
        assert got
        for r in got:
            assert [r[c] for c in CLASHES] == [100 * r["doc_id"] + k for k in range(len(CLASHES))]
