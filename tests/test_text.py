import pytest

from gridmart.sources.text import BAD_LINE, ORDER, read_text_table


def write(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_quotes_tokens_and_accents(spark, tmp_path):
    path = write(tmp_path, "a.csv", (
        "id,name,url\n"
        '1,"Quill, ""IQ""",http://x\n'
        '2,"",\\N\n'
        '3,São Paulo,"http://y/a,b"\n'
        "4, NA ,X\\N\n"
        "5,None,n/A\n"))
    rows = {r.id: (r.name, r.url) for r in read_text_table(spark, path).collect()}
    assert rows == {
        "1": ('Quill, "IQ"', "http://x"), "2": (None, None), "3": ("São Paulo", "http://y/a,b"),
        "4": (" NA ", "X\\N"), "5": (None, "n/A"),
    }


def test_tokens_can_be_kept(spark, tmp_path):
    path = write(tmp_path, "a.csv", "id,name\n1,\\N\n")
    assert read_text_table(spark, path, keep_tokens=True).first()["name"] == "\\N"


def test_ragged_lines_are_reported_whatever_is_selected(spark, tmp_path):
    path = write(tmp_path, "a.csv", "id,a,b\n1,x,y\n2,x\n3,x,y,z\n")
    rows = read_text_table(spark, path).select("id", BAD_LINE).collect()
    assert {r["id"]: r[BAD_LINE] for r in rows} == {"1": None, "2": "2,x", "3": "3,x,y,z"}


def test_header_names_decide_not_positions(spark, tmp_path):
    one = write(tmp_path, "one.csv", "id,a\n1,x\n")
    two = write(tmp_path, "two.csv", "extra,a,id\n-,x,1\n")
    pick = lambda path: read_text_table(spark, path).select("id", "a").collect()
    assert pick(one) == pick(two)


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'id,a\n1,"x\ny"\n2,z\n')
    whole = read_text_table(spark, path, multiline=True).collect()
    assert [(r.id, r.a, r[BAD_LINE]) for r in whole] == [("1", "x\ny", None), ("2", "z", None)]
    # Without it the broken record is reported, not silently accepted.
    assert any(r[BAD_LINE] for r in read_text_table(spark, path).collect())


def test_order_follows_the_file_across_blocks(spark, tmp_path):
    """Many small blocks, read by many tasks: the order is still the order of the lines."""
    n = 20_000
    path = write(tmp_path, "big.csv", "id,pad\n" + "".join(f"{i},{'x' * 40}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        rows = read_text_table(spark, path)
        assert rows.rdd.getNumPartitions() > 4
        ids = [int(r.id) for r in rows.orderBy(ORDER).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ids == list(range(n))


def test_a_file_with_another_header_is_refused(spark, tmp_path):
    """Files of one table must agree; cells never end up under the wrong name."""
    folder = tmp_path / "t.csv"
    folder.mkdir()
    write(folder, "part-0.csv", "id,a\n1,x\n")
    write(folder, "part-1.csv", "a,id\ny,2\n")
    with pytest.raises(Exception, match="header"):
        read_text_table(spark, str(folder)).collect()


def test_many_files_are_one_table_in_name_order(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    for i in reversed(range(12)):
        write(folder, f"part-{i:02d}.csv", f"id\n{i}a\n{i}b\n")
    ids = [r.id for r in read_text_table(spark, str(folder)).orderBy(ORDER).collect()]
    assert ids == [f"{i}{x}" for i in range(12) for x in "ab"]


def test_first_row_is_that_of_the_first_path(spark, tmp_path):
    """Two files of one name: the larger one is packed first, the first path comes first."""
    from gridmart.operators.keys import first_rows

    for season, lines in (("season=1", 3), ("season=2", 4000)):
        (tmp_path / "t" / season).mkdir(parents=True)
        (tmp_path / "t" / season / "part-0.csv").write_text("k,v\n" + "".join(f"{i},{season}\n" for i in range(7, 7 + lines)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("100", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = read_text_table(spark, str(tmp_path / "t"))
            firsts = {r.k: r.v for r in first_rows(rows, ["k"], [ORDER]).where("k < 10").collect()}
            assert firsts["7"] == firsts["8"] == firsts["9"] == "season=1"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
