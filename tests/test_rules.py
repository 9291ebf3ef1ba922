"""Value, header and path rules."""

import pytest
from pyspark.sql import functions as F

from filestrata.functions import headers as H
from filestrata.functions import paths as P
from filestrata.functions import text as T


def values(spark, rule, *inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r.out for r in df.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


def test_contract_number(spark):
    got = values(spark, T.contract_number, "VALE5900052656", "ALPA5900065869",
                 "5900055119", "", None, "٣٤5", "５９", "²3", "abc", "5900055119.0")
    assert got == ["5900052656", "5900065869", "5900055119", None, None, "٣٤5", "５９",
                   "3", None, "59000551190"]


def test_null_tokens(spark):
    assert values(spark, lambda c: T.null_tokens("v"), *T.NULL_TOKENS) == [None] * len(T.NULL_TOKENS)
    assert values(spark, lambda c: T.null_tokens("v"), " NA", "Na", "x", None) == [" NA", "Na", "x", None]
    assert values(spark, lambda c: T.null_tokens("v", ()), "NA", "") == ["NA", ""]


def test_stringify_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, True)], "a int, `b.c` string, d boolean")
    out = T.stringify(df)
    assert [f.dataType.simpleString() for f in out.schema] == ["string"] * 3
    assert tuple(out.first()) == ("1", None, "true")


def test_contains_text_and_elapsed(spark):
    assert values(spark, lambda c: T.contains_text(c, "NACT"), "x/NACT/y", "nact", None) == [
        True, False, False]
    out = spark.sql("select timestamp'2024-01-01 00:00:00' a, timestamp'2024-01-01 00:00:01.5' b")
    assert out.select(T.elapsed_seconds(F.col("a"), F.col("b"))).first()[0] == 1.5


@pytest.mark.parametrize("raw, technical", [
    ("Número Contrato", "numero_contrato"), ("Nº", "no"), ("SALDO (%)", "saldo"),
    ("***", ""), ("PROJETO/ÁREA DE OPERAÇÃO VALE", "projeto_area_de_operacao_vale"),
    ("Unnamed: 2", "unnamed_2"), ("valor.1", "valor_1"), ("__a--b__", "a_b")])
def test_technical_name(raw, technical):
    assert H.technical_name(raw) == technical


@pytest.mark.parametrize("raw, name", [
    ("SALDO (%)", "saldo_(percentual)"), ("PRAZO - INÍCIO", "prazo_-_inicio"),
    ("P.O", "po"), (" PROJETO/ÁREA ", "projeto_area"), ("a  b", "a__b")])
def test_layout_name(raw, name):
    assert H.layout_name(raw) == name


def test_unique_names():
    assert H.reader_names(["valor", "valor", "", None], 5) == [
        "valor", "valor.1", "Unnamed: 2", "Unnamed: 3", "Unnamed: 4"]
    assert H.technical_names(["valor", "valor", "Valor"]) == ["valor", "valor_1", "valor_2"]
    assert H.technical_names(["a", "a", "a_1"]) == ["a", "a_2", "a_1"]
    assert H.technical_names(["***", "x", "!"]) == ["col_0", "x", "col_2"]
    assert H.technical_names(["Dataset", "x"], reserved=["dataset"]) == ["dataset_1", "x"]


def test_source_type(spark):
    assert values(spark, P.source_type, "arquivo.csv", "arquivo.XLSX", "a.b.xlsb", "x.txt",
                  "noext") == ["csv", "xlsx", "xlsb", None, None]
    assert values(spark, P.source_type_error, "a.csv", "a.TXT", "noext") == [
        None, "Unsupported extension: txt", "Unsupported extension: "]
    assert values(spark, P.reader_error, "csv", "oracle", "zip") == [
        None, "Reader not implemented: oracle", "Reader not found: zip"]


def test_dataset_name(spark):
    df = spark.createDataFrame([
        (0, "QEC_5900055119_7_55_77.csv", None),
        (1, "2024-02-Monitoramento.xlsx", "/RAW/2024-02-01_0800/NACT/2024-02-Monitoramento.xlsx"),
        (2, "x.csv", "c:\\raw\\nact\\x.csv"),
        (3, "ControleMedicoesPagamentos.csv", None),
        (4, "qec_1.csv", "/a/b"),
        (5, "Relatório Geral-2.v1.csv", "/a/b"),
        (6, "Controle_Subcontratadas.xlsx", "/a"),
    ], "i int, f string, p string")
    out = df.select("i", P.dataset_name(F.col("f"), F.col("p")).alias("d")).orderBy("i")
    assert [r.d for r in out.collect()] == [
        "qec", "nact", "nact", "controle_medicoes_pagamentos", "qec_1",
        "relatório_geral_2.v1", "controle_subcontratadas"]


def test_suffix_and_stem(spark):
    names = ("a.tar.gz", ".hidden", "plain", "x.", "a b.CSV")
    assert values(spark, P.suffix, *names) == [".gz", "", "", "", ".CSV"]
    assert values(spark, P.stem, *names) == ["a.tar", ".hidden", "plain", "x.", "a b"]


def test_plain_path(spark):
    got = values(spark, P.plain_path, "file:/tmp/sub%20%C3%A9/a%5B1%5D+b.csv",
                 "file:///x/y.csv", "s3a://bucket/a%20b.csv")
    assert got == ["/tmp/sub é/a[1]+b.csv", "/x/y.csv", "s3a://bucket/a b.csv"]
