"""Broken records go to a table of their own; every other one is loaded, and all are counted."""

import json
import os
import tempfile

import pytest

from cartwheel.sources import checked
from cartwheel.sources import json_arrays as ja

SF = "/root/testdata/sf0.001"
PRODUCT = {"product_id": "p1", "category_id": "c", "base_price": "3.5", "price_history": [{"price": 1.0, "date": "2024-01-01"}]}


def folder(**files):
    out = tempfile.mkdtemp(prefix="cartwheel-checked-")
    for name, text in files.items():
        with open(os.path.join(out, f"{name}.json"), "w") as f:
            f.write(text)
    return out


def loaded(spark, name, **files):
    return checked.load_dataset(spark, folder(**files), name, tempfile.mkdtemp(prefix="cartwheel-load-") + "/out")


def reasons(x):
    return sorted((r.element, r.reason) for r in x.rejects.collect())


def test_array_elements_that_do_not_fit(spark):
    elements = [PRODUCT, 17, {**PRODUCT, "current_stock": "many", "is_active": 3}, "text", {**PRODUCT, "product_id": "p5"},
                {**PRODUCT, "price_history": {"a": 1}}, [PRODUCT], None, {**PRODUCT, "base_price": "none"}, {}]
    x = loaded(spark, "products", products=json.dumps(elements))
    assert reasons(x) == [(1, "no object"), (2, "does not fit: current_stock, is_active"), (3, "no object"),
                          (5, "does not fit: price_history"), (6, "no object"), (7, "no object")]
    assert sorted(str(r.product_id) for r in x.documents.collect()) == ["None", "p1", "p1", "p5"]
    # a price that is no number and a record without fields fit the schema, but not the cleaning rule
    assert (x.read, x.rejected, x.removed, x.kept) == (10, 6, 2, 2)
    stored = {r.element: r.record for r in x.rejects.collect()}
    assert json.loads(stored[2])["current_stock"] == "many" and all("products.json" in r.file for r in x.rejects.collect())


def test_lines_cut_off_and_both_layouts(spark):
    good = json.dumps(PRODUCT)
    x = loaded(spark, "products", products=f"[{good},{good}]", products_1="\n".join([good, good[:-3], "", "  ", good + "", "{]", good[1:]]))
    assert reasons(x) == [(None, "no object"), (None, "not JSON"), (None, "not JSON")]
    assert (x.read, x.rejected, x.removed) == (7, 3, 0) and x.documents.count() == 4


def test_nothing_to_load(spark):
    for x in (loaded(spark, "products"), loaded(spark, "users", users="[]")):
        assert (x.read, x.rejected, x.removed, x.kept) == (0, 0, 0, 0)
        assert x.documents.count() == x.rejects.count() == 0
    x = loaded(spark, "products", products="[1]")
    assert x.documents.count() == 0 and x.rejects.count() == 1


def test_a_file_broken_as_a_whole_is_an_error(spark):
    with pytest.raises(Exception, match="not one complete JSON array"):
        loaded(spark, "products", products=json.dumps([PRODUCT, PRODUCT])[:-20])


def test_sound_documents_come_back_as_they_were(spark):
    from cartwheel.sources.catalog import Shop

    docs = Shop.from_testdata(spark, SF).transactions
    out = tempfile.mkdtemp(prefix="cartwheel-checked-")
    x = checked.load(checked.records(spark, ja.write_arrays(docs, out, "transactions", 100)), docs.schema, out + "/loaded")
    assert x.read == docs.count() and x.rejected == x.removed == 0
    assert x.documents.exceptAll(docs).count() == 0 and docs.exceptAll(x.documents).count() == 0
