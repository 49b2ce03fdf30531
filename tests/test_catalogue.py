from collections import Counter

import duckdb

import __spark_entry__ as e


def by_sql(name, d):
    db = duckdb.connect()
    for t in ("kg_triples", "kg_link", "kg_text", "kg_image", "interactions", "documents", "rule_terms", "canon_values", "relation_types"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    got = db.sql(e.oracle_sql()[name])
    return got.columns, Counter(got.fetchall())


def both(spark, name, d):
    df = e.queries()[name](spark, d)
    columns, rows = by_sql(name, d)
    assert df.columns == columns
    assert Counter(map(tuple, df.collect())) == rows
    return rows


def test_ntriples_graph_has_all_blocks(spark, sf):
    lines = "\n".join(r[0] for r in both(spark, "ntriples_graph", sf))
    for part in ("/product/", "22-rdf-syntax-ns#type> <http://schema.org/Product>", "<http://schema.org/description>", "<http://schema.org/image>", "/relation/hasColor>", "/entity/hasColor/", "<https://kg.example/relation/hasSubtype> <https://kg.example/type/"):
        assert part in lines, part
    n = lambda t, where: spark.read.parquet(f"{sf}/{t}.parquet").filter(where).count()
    whole = sum(by_sql("ntriples_graph", sf)[1].values()) - sum(by_sql("ntriples_export", sf)[1].values())
    assert whole == 2 * n("kg_link", "product_id IS NOT NULL") + n("kg_text", "product_id IS NOT NULL AND text IS NOT NULL") + n("kg_image", "product_id IS NOT NULL AND url IS NOT NULL") + n("kg_triples", "relation = 'hasSubtype'")


def test_half_matrix_all_has_every_category(spark, sf):
    rows = both(spark, "half_matrix_all", sf)
    categories = {r.category for r in spark.read.parquet(f"{sf}/interactions.parquet").filter("category IS NOT NULL").select("category").distinct().collect()}
    assert set(by_sql("half_matrix_all", sf)[0]) == {"category_a"} | categories
    pairs = sum(by_sql("shared_users", sf)[1].values())
    assert sum(v is not None for r in rows for v in r[1:]) == pairs > sum(v is not None for r in by_sql("half_matrix", sf)[1] for v in r[1:])


def test_worked_examples_sources_and_sinks(spark, sf):
    for name in (
        "op_person_name", "op_normalize_dimensions", "op_extract_sizes", "op_fix_encoding", "source_json_lines", "source_json_array", "source_csv", "source_literals", "sink_tsv",
        "sink_interactions", "external_subset", "learn_fold_plural", "audit_missed_merges", "audit_suspicious_merges", "audit_scores", "url_diagnose", "image_form",
    ):
        df = e.queries()[name](spark, sf)
        columns, rows = by_sql(name, sf)
        order = [columns.index(c) for c in df.columns]
        assert Counter(map(tuple, df.collect())) == Counter(tuple(float(r[i]) if type(r[i]).__name__ == "Decimal" else r[i] for i in order) for r in rows.elements()), name
