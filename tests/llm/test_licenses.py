import pytest

from loomcast.llm.licenses import LICENSES, scan_licenses
from tests.llm.conftest import no_documents


def found(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: (r.license, r.notices) for r in scan_licenses(table).collect()}


@pytest.fixture(scope="module")
def mit():
    return LICENSES["MIT"]


def test_canonical_forms(spark, mit):
    texts = [
        mit,
        "MIT License\n\nCopyright (c) 2020 Some One\n\n" + mit,
        "(c) 1999 X\nCopyright 2000 Y\n" + mit.upper().replace(",", " ;").replace("\n", "  \n\n "),
        mit.replace("sublicense", "sub license"),
        mit + " And more.",
        LICENSES["Zlib"].replace("acknowledgment", "acknowledgement"),
        "Some text.\nReleased under the MIT Licence\nLicensed under the Apache License, Version 2.0.",
        "It is released under the MIT License. Really.",
    ]
    got = found(spark, texts)
    assert [got[k][0] for k in range(8)] == ["MIT", "MIT", "MIT", None, None, "Zlib", None, None]
    assert got[6][1] == "Apache-2.0,MIT" and got[7][1] == ""


def test_own_texts_may_be_given(spark):
    table = spark.createDataFrame([(1, "Be nice"), (2, "be NICE!")], "doc_id long, text string")
    got = scan_licenses(table, {"nice": ["be nice."]}, {"polite": ["be nice"]}).collect()
    assert [(r.license, r.notices) for r in got] == [("nice", "polite")] * 2


def test_odd_texts(odd):
    table, rows = odd
    got = scan_licenses(table).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows) and all(r.license is None and r.notices == "" for r in got)
    assert scan_licenses(no_documents(table.sparkSession)).count() == 0
