"""Expressions over file names and paths, and the file-routing rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File names with a dataset name of their own.
KNOWN_DATASETS = {
    "ControleMedicoesPagamentos.csv": "controle_medicoes_pagamentos",
    "Exportação_bm_acompanhamento.xlsx": "controle_medicoes_andamento",
    "Controle_Subcontratadas.xlsx": "controle_subcontratadas",
    "AnaliticoProjeto.csv": "analitico_projeto",
    "Relatorio_geral_irregularidades.csv": "relatorio_geral_irregularidades",
}

# The file types that have a reader.
SOURCE_TYPES = ("csv", "xlsx", "xlsb")

# Source types that are declared but have no reader yet.
DECLARED_TYPES = ("json", "parquet", "api", "postgres", "oracle", "sap", "sftp")


def plain_path(uri: Column) -> Column:
    """Decode a scan's ``_metadata.file_path`` to the path as it is written.

    Scans percent-encode it; ``+`` is protected because URL decoding would turn
    it into a space. Local files lose their scheme, other stores keep theirs.
    """
    decoded = F.url_decode(F.regexp_replace(uri, r"\+", "%2B"))
    return F.regexp_replace(decoded, r"^file:/+", "/")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(name: Column) -> Column:
    """Last extension with its dot, in its own case; empty if there is none."""
    return F.regexp_extract(name, r"(?s)^.+(\.[^.]+)$", 1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+$", "")


def source_type(name: Column) -> Column:
    """Reader type from the extension, case-blind; null when unsupported."""
    extension = F.lower(F.regexp_replace(suffix(name), r"^\.", ""))
    return F.when(extension.isin(*SOURCE_TYPES), extension)


def source_type_error(name: Column) -> Column:
    """Why a file has no reader; null when it has one."""
    extension = F.lower(F.regexp_replace(suffix(name), r"^\.", ""))
    return F.when(
        ~extension.isin(*SOURCE_TYPES),
        F.concat(F.lit("Unsupported extension: "), extension),
    )


def reader_error(kind: Column) -> Column:
    """Why a source type given by name cannot be scanned; null when it can."""
    return (
        F.when(kind.isin(*SOURCE_TYPES), F.lit(None).cast("string"))
        .when(kind.isin(*DECLARED_TYPES),
              F.concat(F.lit("Reader not implemented: "), kind))
        .otherwise(F.concat(F.lit("Reader not found: "), F.coalesce(kind, F.lit("null"))))
    )


def dataset_name(name: Column, path: Column | None = None) -> Column:
    """Logical dataset of a file: folder, then prefix, then known name, then stem."""
    folder = F.upper(F.replace(F.coalesce(path, F.lit("")), F.lit("\\"), F.lit("/"))) \
        if path is not None else F.lit("")
    known = F.create_map(*[F.lit(x) for pair in KNOWN_DATASETS.items() for x in pair])
    return (
        F.when(folder.contains("/NACT/"), F.lit("nact"))
        .when(name.startswith("QEC_"), F.lit("qec"))
        .otherwise(F.coalesce(known[name], F.translate(F.lower(stem(name)), " -", "__")))
    )
