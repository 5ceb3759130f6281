"""DuckDB SQL fragments for the oracle side of ``oracle_sql()``.

These restate each query's semantics directly in SQL over the same parquet
views (documents, benchmark, ...); nothing here is executed by Spark.
"""

from __future__ import annotations

TOKEN_RE = "[^a-z0-9]+"


def toks(name: str = "toks", table: str = "documents", id_col: str = "doc_id") -> str:
    return (f"{name} AS MATERIALIZED (SELECT doc_id, term FROM (SELECT {id_col} AS doc_id, "
            f"unnest(string_split_regex(lower(coalesce(text, '')), '{TOKEN_RE}')) AS term "
            f"FROM {table}) WHERE term <> '')")


def classes(label: str, name: str = "cls") -> str:
    return (f"{name} AS (SELECT CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS class_id, name "
            f"FROM (SELECT DISTINCT CAST({label} AS VARCHAR) AS name FROM documents WHERE {label} IS NOT NULL))")


def split(name: str = "split", fraction: float = 0.2) -> str:
    return (f"{name} AS (SELECT doc_id, CASE WHEN rn <= n_train THEN 'train' ELSE 'validation' END AS split "
            f"FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) r, "
            f"(SELECT count(*) - CAST(floor({fraction}::DOUBLE * count(*)) AS BIGINT) AS n_train FROM documents) n)")


def docs(label: str, name: str = "docs") -> str:
    return (f"{name} AS (SELECT d.doc_id, c.class_id FROM documents d "
            f"LEFT JOIN cls c ON CAST({label if label.startswith('(') else 'd.' + label} AS VARCHAR) = c.name)")


def nb_model(train_filter: str, vocab_from: str = "toks", beta: str | None = None) -> list[str]:
    """CTEs trd (train docs), tr (train tokens), wc, cstat, nn, vv, bb, lik_den.

    ``train_filter`` is a predicate over (doc_id) selecting training docs;
    ``vocab_from`` the token CTE(s) defining the shared vocabulary.
    """
    b = beta or "1.0 / (SELECT v FROM vv)"
    return [
        f"trd AS (SELECT doc_id, class_id FROM docs WHERE class_id IS NOT NULL AND {train_filter})",
        "tr AS (SELECT t.doc_id, t.term, d.class_id FROM toks t JOIN trd d USING (doc_id))",
        "wc AS (SELECT class_id, term, count(*) AS c FROM tr GROUP BY class_id, term)",
        "cstat AS (SELECT c.class_id, (SELECT count(*) FROM trd WHERE trd.class_id = c.class_id) AS n_docs, "
        "(SELECT count(*) FROM tr WHERE tr.class_id = c.class_id) AS n_words FROM cls c)",
        "nn AS (SELECT sum(n_docs) AS n FROM cstat)",
        f"vv AS (SELECT count(DISTINCT term) AS v FROM {vocab_from})",
        f"bb AS (SELECT {b} AS beta)",
        "prior AS (SELECT class_id, CASE WHEN n_docs > 0 THEN log2(n_docs / (SELECT n FROM nn)) "
        "ELSE '-inf'::DOUBLE END AS lp, n_words + (SELECT beta FROM bb) * (SELECT v FROM vv) AS den FROM cstat)",
    ]


def nb_scores(test_docs: str, test_toks: str) -> list[str]:
    """CTE sc(doc_id, class_id (true), score_class, score) for documents in
    ``test_docs`` (doc_id, class_id) with tokens ``test_toks`` (doc_id, term)."""
    return [
        f"ttok AS (SELECT t.doc_id, t.term FROM {test_toks} t JOIN {test_docs} d USING (doc_id))",
        "tsum AS (SELECT t.doc_id, p.class_id, sum(log2((coalesce(w.c, 0) + (SELECT beta FROM bb)) / p.den)) AS a "
        "FROM ttok t CROSS JOIN prior p LEFT JOIN wc w ON w.term = t.term AND w.class_id = p.class_id "
        "GROUP BY t.doc_id, p.class_id)",
        f"sc AS (SELECT d.doc_id, d.class_id, p.class_id AS score_class, coalesce(s.a, 0) + p.lp AS score "
        f"FROM {test_docs} d CROSS JOIN prior p LEFT JOIN tsum s ON s.doc_id = d.doc_id AND s.class_id = p.class_id)",
        "pred AS (SELECT doc_id, class_id, score_class AS predicted FROM (SELECT *, row_number() OVER "
        "(PARTITION BY doc_id ORDER BY score DESC, score_class) AS rk FROM sc) WHERE rk = 1)",
    ]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
