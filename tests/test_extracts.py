"""CSV extract contract: presence, emptiness, header by name, strict parsing."""

import os

import pytest

from conftest import SF001
from martforge.plans.staging import derived_staging
from martforge.schemas import STG_PRODUCTS
from martforge.sources import extracts as X


def test_round_trip(spark, tmp_root):
    st = derived_staging(spark, SF001)
    X.write_extracts(st, tmp_root)
    back = X.ingest(spark, tmp_root)
    for name, df in back.tables().items():
        orig = st.tables()[name]
        assert df.columns == orig.columns
        assert df.exceptAll(orig).count() == 0 and orig.exceptAll(df).count() == 0


def test_missing_and_empty_files(spark, tmp_root):
    open(os.path.join(tmp_root, "products.csv"), "w").write("")
    with pytest.raises(X.SourceError) as e:
        X.validate_source(spark, tmp_root)
    msg = str(e.value)
    assert "customers.csv: missing" in msg and "products.csv: empty" in msg


def test_header_by_name_reordered_with_extras(spark, tmp_root):
    p = os.path.join(tmp_root, "p.csv")
    open(p, "w").write(" price ,product_id, extra,category,product_name\n1.5,7,x,A,foo\n,8,y,B,\n")
    rows = X.read_extract(spark, p, STG_PRODUCTS).collect()
    assert [tuple(r) for r in rows][0][:3] == (7, "foo", "A")
    assert rows[1]["price"] is None and rows[1]["product_name"] is None


def test_missing_column_and_bad_value(spark, tmp_root):
    p = os.path.join(tmp_root, "p.csv")
    open(p, "w").write("product_id,product_name,price\n1,x,1.0\n")
    with pytest.raises(X.SourceError):
        X.read_extract(spark, p, STG_PRODUCTS)
    b = os.path.join(tmp_root, "b.csv")
    open(b, "w").write("product_id,product_name,category,price\nabc,x,y,1.0\n")
    with pytest.raises(Exception):
        X.read_extract(spark, b, STG_PRODUCTS).write.format("noop").mode("overwrite").save()


def bad_products(tmp_root):
    p = os.path.join(tmp_root, "products.csv")
    open(p, "w").write("category, price ,product_id,more,product_name\nA,1.5,7,x,foo\nB,cheap,8,y,bar\n,,9,z,\nC,2.0,ten,x,baz\n"
                       "D,3.0,11\nE,4.0,12,x,ok,surplus\nF,dear,none,x,both\n\"G, quoted\",5.00,13,x,ok\n")
    return p


def test_rejects_have_file_reasons_and_line(spark, tmp_root):
    path = bad_products(tmp_root)
    taken = X.take_in(spark, path, "products.csv", STG_PRODUCTS)
    rows = sorted(map(tuple, taken.rows.collect()))
    assert [r[0] for r in rows] == [7, 9, 13] and rows[1][1:] == (None, None, None) and rows[2][2] == "G, quoted"
    assert taken.counts() == (8, 5)
    got = {r.line: (r.reasons, r.extract, os.path.basename(r.file)) for r in taken.rejects.collect()}
    assert {k.split(",")[0]: v[0] for k, v in got.items()} == {
        "B": ["bad_price"], "C": ["bad_product_id"], "D": ["field_count"], "E": ["field_count"],
        "F": ["bad_product_id", "bad_price"]}
    assert all(v[1:] == ("products.csv", "products.csv") for v in got.values())


def test_one_bad_date_loads_the_rest(spark, tmp_root):
    from martforge.plans.checks import GateFailed
    from martforge.plans.publish import Store
    from martforge.plans.warehouse import line_intake, run_from_extracts
    src = os.path.join(tmp_root, "raw")
    X.write_extracts(derived_staging(spark, SF001), src)
    with open(os.path.join(src, "orders.csv", "part-bad.csv"), "w") as f:
        f.write("order_id,customer_id,order_date,payment_method,order_status\n900001,1,1995-02-31,Card,Completed\n")
    with open(os.path.join(src, "order_items.csv", "part-bad.csv"), "w") as f:
        f.write("order_id,product_id,quantity,unit_price\n1,1,two,3.00\n")
    with pytest.raises(Exception):
        run_from_extracts(spark, src, os.path.join(tmp_root, "wh"))
    assert Store(spark, os.path.join(tmp_root, "wh")).current() is None
    wh = run_from_extracts(spark, src, os.path.join(tmp_root, "wh"), strict=False)
    rejects = {(r.extract, r.line, tuple(r.reasons)) for r in wh.store.read("rejects", wh.run_id).collect()}
    assert rejects == {("orders.csv", "900001,1,1995-02-31,Card,Completed", ("bad_order_date",)),
                       ("order_items.csv", "1,1,two,3.00", ("bad_quantity",))}
    lines = line_intake(wh).first()
    assert lines.rejected_rows == 1 and lines.read_rows == lines.rejected_rows + lines.excluded_rows + lines.loaded_rows
    with pytest.raises(GateFailed, match="do not parse"):
        run_from_extracts(spark, src, os.path.join(tmp_root, "wh"), strict=False, reject_share=0.0)
