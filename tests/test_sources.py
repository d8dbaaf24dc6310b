"""Sources and sinks on small files written by the tests themselves."""

import os

from pyspark.sql import functions as F

from larch.operators import counts
from larch.operators.rowid import line_ids
from larch.sources import (csv_lines, parse_ragged, parse_ratings, read_csv_table,
                           read_lines, write_csv)

HEADER = "INV_TYPE,EMP_NO,ARROND,ARROND_NOM,Rue,COTE,Nom_parc,No_Civiq"
ROWS = [
    'H,1,1,Nord,rue A,N,Parc Émile,10',          # accented (Latin-1 on disk)
    'H,2,1,Nord,rue B,N,,11',                    # empty label
    'H,3,1,Nord,rue C,N,"",12',                  # quoted empty label
    'H,4,1,Nord,rue D,N,"  ",13',                # blank-only label
    'H,5,1,Nord,rue E,N,NA,14',                  # the text NA
    'H,6,1,Nord,rue F,N,"Parc, du Nord",15',     # comma inside quotes
    'H,7,1,Nord,rue G,N,"Parc\nLigne",16',       # quoted line break
    'H,8,1,Nord,short',                          # too few fields
    'H,9,1,Nord,rue H,N,Parc Émile,17,x,y',      # too many fields
    'H,10,1,Nord,rue I,N,Parc Alpha,18',
    'H,11,1,Nord,rue J,N,Parc Alpha,19',
    'H,12,1,Nord,rue K,N,Parc Beta,20',
    'H,13,1,Nord,rue L,N,Parc Beta,21',
    'H,14,1,Nord,rue M,N,Parc Émile,22',
]


def write_trees(tmp_dir, rows=ROWS, name="trees.csv"):
    path = os.path.join(tmp_dir, name)
    with open(path, "w", encoding="latin-1", newline="\n") as f:
        f.write(HEADER + "\n")
        for r in rows:
            f.write(r + "\n")
    return path


def test_csv_counts_agree_whatever_is_selected(spark, tmp_dir):
    df = read_csv_table(spark, write_trees(tmp_dir), encoding="ISO-8859-1", multi_line=True)
    n_all = df.count()
    n_label = df.select("Nom_parc").count()
    n_rows = len(df.collect())
    assert n_all == n_label == n_rows == 12  # short and long rows dropped


def test_csv_labels_multiline(spark, tmp_dir):
    df = read_csv_table(spark, write_trees(tmp_dir), encoding="ISO-8859-1", multi_line=True)
    # Empty and quoted-empty labels are NULL; blank-only and NA are values.
    assert counts.present_count(df, "Nom_parc").first().n == 10
    got = [tuple(r) for r in counts.value_counts(df, "Nom_parc").collect()]
    # Code-point order: a line break sorts before a space.
    assert got == [("  ", 1), ("NA", 1), ("Parc\nLigne", 1), ("Parc Alpha", 2),
                   ("Parc Beta", 2), ("Parc Émile", 2), ("Parc, du Nord", 1)]
    top = [tuple(r) for r in counts.top_values(df, "Nom_parc", k=3).collect()]
    assert top == [("Parc Alpha", 2), ("Parc Beta", 2), ("Parc Émile", 2)]


def test_csv_single_line_mode_is_consistent(spark, tmp_dir):
    df = read_csv_table(spark, write_trees(tmp_dir), encoding="ISO-8859-1")
    assert df.count() == df.select("Nom_parc").count() == len(df.collect())


def test_csv_header_only(spark, tmp_dir):
    df = read_csv_table(spark, write_trees(tmp_dir, rows=[], name="empty.csv"))
    assert df.columns == HEADER.split(",")
    assert df.count() == 0
    assert counts.top_values(df, "Nom_parc").count() == 0


def test_common_values_across_files(spark, tmp_dir):
    a = read_csv_table(spark, write_trees(tmp_dir, name="a.csv"), encoding="ISO-8859-1",
                       multi_line=True)
    b = read_csv_table(spark, write_trees(tmp_dir, rows=ROWS[9:], name="b.csv"),
                       encoding="ISO-8859-1", multi_line=True)
    got = [r.Nom_parc for r in counts.common_values(a, b, "Nom_parc").collect()]
    assert got == ["Parc Alpha", "Parc Beta", "Parc Émile"]


def test_parse_ratings_drops_bad_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ratings.txt")
    with open(path, "w") as f:
        f.write("0::2::3::1424380312\n0::3::1::1424380312\nx::4::2::1\n1::5::4.5::1\n2::7\n")
    got = [tuple(r) for r in parse_ratings(read_lines(spark, path)).collect()]
    assert got == [(0, 2, 3.0), (0, 3, 1.0), (1, 5, 4.5)]
    types = dict(parse_ratings(read_lines(spark, path)).dtypes)
    assert types == {"userId": "bigint", "itemId": "bigint", "rating": "double"}


def test_parse_ragged_and_line_ids(spark, tmp_dir):
    path = os.path.join(tmp_dir, "baskets.txt")
    with open(path, "w") as f:
        f.write("rosa,qc,on,qc\nabies\nacer,ca,az\nzea,ny\n")
    parsed = line_ids(parse_ragged(read_lines(spark, path))).orderBy("id")
    got = [(r.id, r.name, list(r["items"])) for r in parsed.collect()]
    assert got == [(0, "rosa", ["qc", "on", "qc"]), (1, "abies", []),
                   (2, "acer", ["ca", "az"]), (3, "zea", ["ny"])]


def test_line_ids_many_splits(spark, tmp_dir):
    path = os.path.join(tmp_dir, "many.txt")
    with open(path, "w") as f:
        for i in range(20000):
            f.write(f"line{i}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 5
        ids = line_ids(lines)
        bad = ids.where(F.col("value") != F.concat(F.lit("line"), F.col("id").cast("string")))
        assert bad.count() == 0
        assert ids.count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_lines_quoting(spark):
    df = spark.createDataFrame([("plain", 1), ('has "q"', 2), ("a,b", 3), (None, 4)],
                               "label string, n long")
    got = [r.line for r in csv_lines(df).collect()]
    assert got == ["plain,1", '"has ""q""",2', '"a,b",3', ",4"]
    arr = spark.createDataFrame([(1, ["x", "y"])], "id int, items array<string>")
    assert csv_lines(arr).first().line == "1,x y"


def test_write_csv_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("a,b", 1), ("c", 2)], "label string, n int")
    out = os.path.join(tmp_dir, "out")
    write_csv(df.coalesce(1), out)
    back = spark.read.option("header", True).schema("label string, n int").csv(out)
    assert sorted(tuple(r) for r in back.collect()) == [("a,b", 1), ("c", 2)]


def test_line_ids_of_a_folder_equal_its_concatenation(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "many")
    os.makedirs(folder)
    lines = []
    for f, n in enumerate((300, 0, 1, 77)):
        own = [f"{f}:{i}" for i in range(n)]
        lines += own
        with open(os.path.join(folder, f"f{f}.txt"), "w") as out:
            out.write("".join(line + "\n" for line in own))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        ids = line_ids(read_lines(spark, folder)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.value for r in sorted(ids, key=lambda r: r.id)] == lines
    assert sorted(r.id for r in ids) == list(range(len(lines)))


def test_rating_ids_beyond_int_stay(spark):
    lines = spark.createDataFrame([("3000000000::2::5::4",), ("1::5000000000::3::1",), ("x::1::1::1",)], "value string")
    assert sorted(tuple(r) for r in parse_ratings(lines).collect()) == [
        (1, 5000000000, 3.0), (3000000000, 2, 5.0)]


def test_csv_lines_quote_for_their_separator(spark):
    df = spark.createDataFrame([("a;b", "x,y")], "p string, q string")
    assert csv_lines(df, sep=";").first().line == '"a;b";x,y'
    assert csv_lines(df).first().line == 'a;b,"x,y"'
