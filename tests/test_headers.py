import gzip
import os

import pytest

from conftest import rows
from predial.contracts import ContractError
from predial.sources import headers
from predial.sources.text import WIDTH, read_headered


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        for name, text in files.items():
            (tmp_path / f"{name}.csv").write_bytes(text if isinstance(text, bytes) else text.encode())
        return str(tmp_path)

    return write


def test_each_file_goes_by_its_own_header(spark, folder):
    path = folder(one="A,B,C\n1,2,3\n", two="c,a,b\n6,4,5\n", three="B,A\n8,7\n", none="")
    df = read_headered(spark, path, ["a", "b", "c"])
    assert df.columns == ["a", "b", "c"]
    assert rows(df) == [("1", "2", "3"), ("4", "5", "6"), ("7", "8", None)]
    df = read_headered(spark, path)
    assert set(df.columns) in ({"A", "B", "C"}, {"a", "b", "c"}) and df.count() == 3


def test_marks_go_by_the_files_own_width(spark, folder):
    path = folder(one="a,b,c\n1,2,3\n1,2\n", two="b,a\n8,7\n8,7,6\n")
    df = read_headered(spark, path, ["a", "b", "c"], marked=True)
    assert rows(df) == [("1", "2", "3", None), ("7", "8", None, None),
                        (None, None, None, "corta"), (None, None, None, "larga")]
    assert df.columns[-1] == WIDTH


def test_other_titles_go_by_position_if_there_is_one_such_header(spark, folder):
    path = folder(one="X 1,X 2\n1,2\n", two="X 1,X 2\n3,4\n")
    assert rows(read_headered(spark, path, ["a", "b"])) == [("1", "2"), ("3", "4")]


@pytest.mark.parametrize("other", ["X 2,X 1\n3,4\n", "a,b\n3,4\n", "X 1\n3\n", "X 1,X 1\n3,4\n"])
def test_headers_that_cannot_be_matched_are_refused(spark, folder, other):
    with pytest.raises(ContractError, match="expected, found"):
        read_headered(spark, folder(one="X 1,X 2\n1,2\n", two=other), ["a", "b"])


def test_unknown_title_without_names(spark, folder):
    with pytest.raises(ContractError):
        read_headered(spark, folder(one="a,b,c\n1,2,3\n", two="a,d\n1,2\n"))


def test_first_lines(spark, folder):
    long = ",".join(f"column_{i}" for i in range(5000))
    packed = gzip.compress(b"a,b\n1,2\n")
    path = folder(long=f"{long}\r\n{long}\n", bom=b"\xef\xbb\xbf\"a, x\",b\n1,2\n", alone="z")
    with open(os.path.join(path, "packed.csv.gz"), "wb") as out:
        out.write(packed)
    found = headers.files_by_header(spark, path, ",")
    assert sorted(map(len, found)) == [1, 2, 2, 5000] and ("a, x", "b") in found and ("a", "b") in found


def test_no_files_content(spark, folder):
    with pytest.raises(ContractError, match="none read"):
        read_headered(spark, folder(one=""), ["a"])
