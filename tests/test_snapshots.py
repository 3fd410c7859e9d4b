import datetime
import os

from shelfwatch.plans.aggregate import clean_shops
from shelfwatch.sources import snapshots

HEAD = "shop,id,reference,name,price,inStock,taxo1,taxo2,taxo3,taxo4,URL,date"
FILES = {
    "GAP_2018-9-1.csv": HEAD + "\nGAP,1,u,\"Blue, \"\"new\"\" jeans\",35.00,True,gap,men,jeans,slim,https://x,2018-09-01 07:12:03.120000\n"
    + "GAP,2,u,Polo shirt,9.50,True,men,tops,,,,2018-09-01 07:12:04.000000\n",
    "GAP_2018-9-1_before_clean.csv": HEAD + "\nGAP,1,u,raw,1,True,men,a,b,c,d,2018-09-01 07:12:03\n",
    "MS_2018-8-1.csv": "shop,id,reference,name,price,inStock,taxo1,taxo2,taxo3,url,date\nM&S,7,,Denim jeans,12,True,women,a,b,https://old,2018-08-01 1:0:0\n",
    "MS_2018-9-1.csv": HEAD + "\nMS,7,,Denim jeans,,False,women,a,b,,https://new,2018-09-01 1:0:0\n",
    "ZARA_2018-9-1.csv": HEAD + "\nZARA,5,r,\"('SLIM JEANS',)\",1999,True,MAN,JEANS,None,nan,,2018-09-01 1:0:0\nZARA,6,r,,500,True,MAN,JEANS,x,,,2018-09-01 1:0:0\n",
    "PRIMARK_2018-9-1.csv": HEAD + "\nPRIMARK,3,s,Tee,1205,True,men,T-Shirts,,,,2018-09-01 1:0:0\nPRIMARK,4,s,Red hoody,500,True,women,Tops,,,,2018-09-01 1:0:0\n",
    "JOHNLEWIS_2018-9-1.csv": HEAD + "\nJOHNLEWIS,3,,x,1,True,men,a,b,,,2018-09-01 1:0:0\n",
    "notes.txt": "GAP",
    "other.csv": "a,b\n1,2\n",
}


def landing(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    sub = tmp_path / "aggregated"
    sub.mkdir()
    (sub / "GAP_all.csv").write_text(HEAD + "\nGAP,9,,x,1,True,men,a,b,,,2018-09-01\n")
    return str(tmp_path)


def test_files_are_chosen_by_name(spark, tmp_path):
    found = snapshots.snapshot_cells(spark, landing(tmp_path)).select("path", "src_shop").distinct().collect()
    assert sorted((os.path.basename(r.path), r.src_shop) for r in found) == [
        ("GAP_2018-9-1.csv", "GAP"), ("MS_2018-8-1.csv", "MS"), ("MS_2018-9-1.csv", "MS"),
        ("PRIMARK_2018-9-1.csv", "PRIMARK"), ("ZARA_2018-9-1.csv", "ZARA"),
    ]


def test_headers_are_matched_by_name(spark, tmp_path):
    df = snapshots.typed_snapshots(snapshots.read_snapshots(spark, landing(tmp_path)))
    got = {(r.src_shop, r.id, r.date[:7]): r for r in df.collect()}
    gap = got[("GAP", "1", "2018-09")]
    assert (gap.name, gap.price, gap.inStock, gap.taxo4, gap.URL) == ('Blue, "new" jeans', 35.0, True, "slim", "https://x")
    assert got[("GAP", "2", "2018-09")].taxo3 is None
    old, new = got[("MS", "7", "2018-08")], got[("MS", "7", "2018-09")]
    assert (old.url_old, old.URL, old.taxo4, old.shop) == ("https://old", None, None, "M&S")
    assert (new.url_old, new.URL, new.price, new.inStock) == (None, "https://new", None, False)
    zara = got[("ZARA", "5", "2018-09")]
    assert (zara.name, zara.taxo3, zara.taxo4) == ("SLIM JEANS", "None", None)


def test_rows_keep_their_file_order(spark, tmp_path):
    for day in (1, 2):
        rows = "".join(f"GAP,{i},u,n,1,True,men,a,b,c,d,2018-09-0{day}\n" for i in range(3000))
        (tmp_path / f"GAP_2018-9-{day}.csv").write_text(HEAD + "\n" + rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = snapshots.read_snapshots(spark, str(tmp_path), multi_line=False)
        got = [(r.date, int(r.id)) for r in df.orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(f"2018-09-0{d}", i) for d in (1, 2) for i in range(3000)]


def test_line_breaks_inside_cells(spark, tmp_path):
    (tmp_path / "GAP_2018-9-1.csv").write_text(HEAD + '\nGAP,1,u,"A\nB",1.0,True,men,a,b,c,d,2018-09-01 1:0:0\nGAP,2,u,"say ""hi""\n,x",1,True,men,a,b,,,2018-09-01 1:0:0\n')
    got = {r.id: (r.shop, r.name, r.date) for r in snapshots.read_snapshots(spark, str(tmp_path)).collect()}
    assert got == {"1": ("GAP", "A\nB", "2018-09-01 1:0:0"), "2": ("GAP", 'say "hi"\n,x', "2018-09-01 1:0:0")}


def test_landing_one_day_at_a_time(spark, tmp_path):
    root, out = landing(tmp_path), str(tmp_path / "landed")
    snapshots.land(spark, root, out, datetime.date(2018, 8, 1))
    assert {r.src_shop for r in spark.read.parquet(out).collect()} == {"MS"}
    for _ in range(2):  # a day landed again replaces itself
        snapshots.land(spark, root, out, datetime.date(2018, 9, 1))
    whole = snapshots.read_snapshots(spark, root)
    assert spark.read.parquet(out).count() == whole.count()


def test_shop_pipelines(spark, tmp_path):
    raw = snapshots.typed_snapshots(snapshots.read_snapshots(spark, landing(tmp_path)))
    got = {(r.shop, r.id, r.date[:7]): r for r in clean_shops(raw).collect()}
    assert set(got) == {
        ("GAP", "1", "2018-09"), ("GAP", "2", "2018-09"), ("MS", "7", "2018-08"), ("MS", "7", "2018-09"),
        ("ZARA", "5", "2018-09"), ("PRIMARK", "3", "2018-09"), ("PRIMARK", "4", "2018-09"),
    }
    gap = got[("GAP", "1", "2018-09")]
    assert (gap.taxo1, gap.taxo2, gap.taxo3, gap.taxo4, gap.price) == ("MAN", "BOTTOM", "JEANS", "slim", 35.0)
    assert (got[("GAP", "2", "2018-09")].taxo2, got[("GAP", "2", "2018-09")].taxo3) == ("", "")
    assert got[("MS", "7", "2018-08")].URL == "https://old" and got[("MS", "7", "2018-09")].URL == "https://new"
    assert got[("ZARA", "5", "2018-09")].price == 19.99
    assert (got[("PRIMARK", "3", "2018-09")].price, got[("PRIMARK", "3", "2018-09")].taxo3) == (12.05, "TSHIRT")
    assert got[("PRIMARK", "4", "2018-09")].taxo3 == "SWEATSHIRT"


def test_large_files_with_line_breaks_are_split(spark, tmp_path):
    """Quotes, commas and line breaks in cells, over many small blocks: the rows of Python's csv module."""
    import csv
    import random

    rng = random.Random(3)
    bits = ["a", "é", '"', ",", "\n", " ", "x" * 30, "'"]
    header = ["shop", "id", "name", "date", "URL"]
    rows = [["ASOS", str(i), "".join(rng.choice(bits) for _ in range(rng.randint(0, 12))), "2018-09-01", f"u{i}"] for i in range(3000)]
    path = tmp_path / "ASOS_2018-9-1.csv"
    with path.open("w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows([header, *rows])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        cells_blocks = snapshots.snapshot_cells(spark, str(tmp_path)).select("seq.src_block").distinct().count()
        got = snapshots.read_snapshots(spark, str(tmp_path)).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert cells_blocks > 10
    assert [(r.id, r.name, r.URL) for r in got] == [(i, n or None, u) for _, i, n, _, u in rows]


def test_wide_rows_are_rejected(spark, tmp_path):
    stray = "HM,2,n," + ",".join(["x"] * 90)
    wide = ",".join(["shop", "id", "name", "date", *[f"c{i}" for i in range(100)]])
    (tmp_path / "HM_2018-9-1.csv").write_text(f"shop,id,name,date\nHM,1,n,2018-09-01\n{stray}\n\nHM,3,n,2018-09-01,\n")
    (tmp_path / "MS_2018-9-1.csv").write_text(wide + "\nMS,4,n,2018-09-01" + ",v" * 100 + "\n")
    got = snapshots.read_snapshots(spark, str(tmp_path)).collect()
    assert sorted((r.src_shop, r.id) for r in got) == [("HM", "1"), ("MS", "4")]
    bad = snapshots.snapshot_rejects(spark, str(tmp_path)).collect()
    assert [(r.shop, r.level, r.message) for r in bad] == [("HM", "MINOR", snapshots.TOO_WIDE)] * 2 and bad[0].url.endswith("HM_2018-9-1.csv")


def test_an_unclosed_quote_ends_with_its_blocks(spark, tmp_path):
    body = "shop,id,name,date\nHM,1,n,2018-09-01\nHM,2,\"open,2018-09-01\n" + "HM,3,n,2018-09-01\n" * 2000
    (tmp_path / "HM_2018-9-1.csv").write_text(body)
    got = snapshots.read_snapshots(spark, str(tmp_path)).collect()
    assert [r.id for r in got][:1] == ["1"] and len(got) <= 2
