from pyspark.sql import functions as F

from cardweave.functions.text import is_blank, java_trim, mask_pan, stem, utf8_text


def test_blank_follows_the_jvm(column_of):
    blank = ["", " ", "\t\n", "\x1c", " ", "\r\n "]
    not_blank = [" ", " x ", " \n", "\x00"]
    assert column_of(is_blank, blank + not_blank) == [True] * len(blank) + [False] * len(not_blank)


def test_trim_removes_all_control_characters(column_of):
    assert column_of(java_trim, ["\tA\n", "\x01 A B \x1f", " A", None, " \t "]) == ["A", "A B", " A", None, ""]


def test_mask(column_of):
    pans = [None, "", "123", "1234", "12345", "4111111111111111"]
    assert column_of(mask_pan, pans) == ["****", "****", "****", "1234", "*2345", "************1111"]


def test_stem(column_of):
    names = ["a.xml", "b.v1.xml", ".hidden", ".hidden.xml", "plain", "dot.", "_x.xml", "..", "a\nb.xml"]
    assert column_of(stem, names) == ["a", "b.v1", ".hidden", ".hidden", "plain", "dot", "_x", ".", "a\nb"]


def test_invalid_bytes_are_replaced(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),), (bytearray("é".encode()),), (None,)], "b BINARY")
    assert [r[0] for r in df.select(utf8_text(F.col("b"))).collect()] == ["a�b", "é", None]
