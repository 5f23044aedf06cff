"""The pipeline's stages on small tables, each on what it gets."""

import random

import corpus_pipeline
from starmart.llm import mixing
from conftest_llm import prose, shingle_set


def test_stages(documents, spark, tmp_path):
    pick = random.Random(6)
    rows, labels = [], []
    for i in range(120):
        text = f"{prose(i, 60)}\n{prose(1000 + i, 40)}"
        if i % 10 == 1:
            text = " ".join(["JUNK!!"] * 80)
        rows.append([i, text, "abcdef"[i % 6]])
        labels.append((i, int(i % 10 != 1), 0))
    for i in (20, 33, 44, 55, 66, 77):
        rows[i][1] += "\nthis line stands on every site there is"
    for i in (82, 84):
        rows[i][1] = rows[2][1] + f" and {i}"
    bench = [(1, prose(5000, 30))]
    rows[90][1] += " " + bench[0][1]
    rows.append([None, None, None])
    documents(*map(tuple, rows)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = docs.columns
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/stage{n}")
        docs = spark.read.parquet(f"{tmp_path}/stage{n}")
        seen.append({r.doc_id: r for r in docs.collect()})
    quality, lines, near, clean, mix = seen
    junk = {i for i in range(120) if i % 10 == 1}
    assert not junk & set(quality) and set(range(120)) - junk <= set(quality)
    changed = {i for i in lines if lines[i].text != quality[i].text}
    assert {33, 44, 55, 66, 77} <= changed and 20 not in changed
    assert all(lines[i].n_chars == len(lines[i].text) for i in lines if lines[i].text is not None)
    sets = {i: shingle_set(r.text, 5) for i, r in lines.items() if i is not None}
    gone = {j for j in sets for i in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert set(near) == set(lines) - gone and gone >= {82, 84}
    assert set(near) - set(clean) == {90}
    assert set(mix) <= set(clean) and docs.count() == mixing.mix(spark.read.parquet(f"{tmp_path}/stage3")).agg({"copies": "sum"}).first()[0]


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 100
