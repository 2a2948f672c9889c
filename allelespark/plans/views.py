"""Genomic-shaped views of the driver's tables, in an SQL that Spark and DuckDB read alike.

Everything is integer arithmetic on the tables' keys.  Contigs use modulus 23, coprime with the four samples; contig
23 is X.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _contig(key: str) -> str:
    return f"CASE WHEN {key} % 23 = 22 THEN 'X' ELSE CAST({key} % 23 + 1 AS STRING) END"


def _sample(key: str) -> str:
    return f"concat('S', CAST({key} % 4 AS STRING))"


def _part(key: str, rows: int) -> str:
    """Where the key's part of a contig begins.  Each part of 500 positions holds so many rows of the table, so larger
    tables have more loci, not deeper ones."""
    return f"500 * CAST(floor({key} / {rows}) AS BIGINT)"


_NUCLEOTIDE = "substr('ACGT', CAST({} AS INT) + 1, 1)"
_PRICE = "CAST(floor({}) AS BIGINT)"

#: name -> (table, {column: expression})
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "pileup_runs": ("lineitem", {
        "sample": _sample("l_suppkey"), "run": "CAST(l_linenumber AS BIGINT)", "contig": _contig("l_partkey"), "position": f"CAST(l_orderkey % 499 + 1 AS BIGINT) + {_part('l_orderkey', 150_000)}",
        "ref_count": "CAST(floor(l_quantity) AS BIGINT)", "alt_count": "CAST(floor(l_discount * 100 + 0.5) AS BIGINT) * (l_linenumber % 3)", "other_alt_count": "CAST(floor(l_tax * 100 + 0.5) AS BIGINT) % 3",
        "allele_frequency": "CAST(((l_partkey % 23 + 1) * 31 + (l_orderkey % 499 + 1) * 7) % 99 + 1 AS DOUBLE) / 100",
    }),
    "copy_ratios": ("orders", {
        "sample": _sample("o_custkey"), "contig": _contig("o_custkey"), "start": f"CAST(o_orderkey % 400 + 1 AS BIGINT) + {_part('o_orderkey', 150_000)}", "stop": f"CAST(o_orderkey % 400 + 6 + o_orderkey % 37 AS BIGINT) + {_part('o_orderkey', 150_000)}",
        "log2_cr": f"CAST({_PRICE.format('o_totalprice')} % 400 - 200 AS DOUBLE) / 100", "ord": "CAST(o_orderkey AS BIGINT)", "call": "CASE WHEN o_orderstatus = 'F' THEN '+' WHEN o_orderstatus = 'O' THEN '0' ELSE '-' END",
    }),
    "segments": ("customer", {
        "sample": _sample("c_custkey"), "contig": _contig("c_custkey"), "start": f"CAST(floor(c_custkey / 4) AS BIGINT) % 20 * 25 + 1 + {_part('c_custkey', 15_000)}", "stop": f"CAST(floor(c_custkey / 4) AS BIGINT) % 20 * 25 + 25 + {_part('c_custkey', 15_000)}", "minor_allele_fraction": "CAST(c_custkey % 50 AS DOUBLE) / 100",
    }),
    "targets": ("part", {"contig": _contig("p_partkey"), "start": f"CAST(p_size * 8 + 1 AS BIGINT) + {_part('p_partkey', 20_000)}", "stop": f"CAST(p_size * 9 + 1 AS BIGINT) + {_part('p_partkey', 20_000)}", "score": "CAST(p_partkey % 10 AS DOUBLE) / 10"}),
    "variants": ("part", {
        "contig": _contig("p_partkey"), "position": f"CAST(p_partkey % 499 + 1 AS BIGINT) + {_part('p_partkey', 20_000)}", "ref": _NUCLEOTIDE.format("p_partkey % 4"), "alt": _NUCLEOTIDE.format("p_size % 4"),
        "filter": "CASE p_partkey % 7 WHEN 0 THEN 'PASS' WHEN 1 THEN 'normal_artifact' WHEN 2 THEN 'germline' WHEN 3 THEN 'germline;panel_of_normals' WHEN 4 THEN 'germline;weak_evidence' WHEN 5 THEN 'base_qual;normal_artifact' ELSE 'normal_artifact;PASS' END",
        "info": f"concat('DP=', CAST({_PRICE.format('p_retailprice')} % 40 AS STRING), ';TAC=', CAST(p_size % 9 AS STRING), ';MBQ=', CAST(p_size % 35 AS STRING), ',', CAST(p_partkey % 33 AS STRING), CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat(';POPAF=', CAST(p_partkey % 6 AS STRING)) END, ';GERMQ=', CAST(p_partkey % 60 AS STRING))",
        "ad": "concat(CAST(p_size AS STRING), ',', CAST(p_partkey % 13 AS STRING), '|', CAST(p_partkey % 17 AS STRING), ',', CAST(p_size % 7 AS STRING))", "dp": "CAST(p_size + p_partkey % 13 + p_partkey % 3 AS BIGINT)", "genotype": "CASE p_partkey % 5 WHEN 0 THEN '0/1' WHEN 1 THEN '1|0' WHEN 2 THEN '0/0' WHEN 3 THEN '1/1' ELSE '0|1' END",
        "sample": _sample("p_partkey"), "ord": "CAST(p_partkey AS BIGINT)",
    }),
    "modeled_segments": ("orders", {
        "sample": _sample("o_custkey"), "contig": _contig("o_custkey"), "start": "CAST(o_orderkey AS BIGINT) * 100 + 1", "stop": "CAST(o_orderkey AS BIGINT) * 100 + 50 + o_orderkey % 50",
        "n_probes": "CAST(o_orderkey % 12 AS BIGINT)", "n_hets": "CAST(o_custkey % 9 AS BIGINT)", "cr50": f"CAST({_PRICE.format('o_totalprice')} % 64 - 32 AS DOUBLE) / 32", "cr10": f"CAST({_PRICE.format('o_totalprice')} % 64 - 34 AS DOUBLE) / 32", "cr90": f"CAST({_PRICE.format('o_totalprice')} % 64 - 30 AS DOUBLE) / 32",
        "maf50": "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 50 AS DOUBLE) / 100 END", "maf10": "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 50 AS DOUBLE) / 125 END", "maf90": "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 50 AS DOUBLE) / 80 END", "call": "CASE WHEN o_orderstatus = 'F' THEN '+' WHEN o_orderstatus = 'O' THEN '0' ELSE '-' END",
    }),
    "reads": ("events", {"contig": "event_type", "start": f"CAST(floor(value) AS BIGINT) + 1 + {_part('event_id', 100_000)}", "stop": f"CAST(floor(value) AS BIGINT) + 1 + event_id % 40 + {_part('event_id', 100_000)}", "flags": "CAST(event_id % 16 * 64 + event_id % 4 AS BIGINT)", "mapq": "CAST(event_id % 61 AS BIGINT)", "clip": "CAST(event_id % 30 AS BIGINT)", "base": _NUCLEOTIDE.format("event_id % 4"), "ord": "CAST(event_id AS BIGINT)"}),
    "contaminations": ("supplier", {"sample": _sample("s_suppkey"), "contamination": "CAST(s_suppkey % 20 AS DOUBLE) / 1000", "error": "CAST(s_suppkey % 9 AS DOUBLE) / 10000"}),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = VIEWS[name]
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def view_sql(name: str) -> str:
    table, columns = VIEWS[name]
    return f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table})"
