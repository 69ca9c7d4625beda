import pytest

from mishap.llm import pii


def _plain(spark, number):
    """A tenth of the texts holds an address and a telephone number; the others a number that is neither."""
    rows = [
        (i, f"write to u{i}@mail.example.com or +49 30 {1000000 + i}" if i % 10 == 0 else f"lot x{i % 97:07d}")
        for i in range(number)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("number", [80, 800])
def test_threshold_does_not_depend_on_the_size(spark, number):
    table = _plain(spark, number)
    assert pii.fit(table).threshold < float("inf")
    assert pii.fit(table, params=pii.Params(texts=40)).threshold < float("inf")


def test_rows_beyond_the_sample_calibrate(spark):
    """The same sample teaches; candidates outside it alone decide the threshold."""
    judged = []
    table = _plain(spark, 800)
    whole = pii._candidates

    def counted(rows):
        judged.append(rows.count())
        return whole(rows)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pii, "_candidates", counted)
        pii.fit(table, params=pii.Params(texts=40))
    assert judged == [40, 760]


def test_candidates_beyond_the_base_spans_are_added(spark):
    """Obfuscated addresses, cards in other groups and national numbers; not what fails a check."""
    extra = {
        9001: "contact jane.doe (at) example (dot) org now",
        9002: "card 4111.1111.1111.1111 it is",
        9003: "phone (030) 555-1234 it is",
        9004: "card 4111.1111.1111.1112 it is",
        9005: "phone 2024-01-15 10 it is",
        9006: "meet me @ home. Thanks",
    }
    rows = [
        (i, f"u{i}@mail.example.com, +{i % 90 + 10} ({i % 900 + 100}) 555-{1000 + i} 4111 1111 1111 1111")
        if i % 3 == 0
        else (i, f"u{i}@mail.example.com or +{i % 90 + 10} ({i % 900 + 100}) 555-{1000 + i}, 4111111111111111.")
        if i % 3 == 1
        else (i, f"lot x{i % 97:07d} no. 41111111111111{i % 8 + 12} of 300.2.3.{i % 200}")
        for i in range(600)
    ]
    table = spark.createDataFrame(rows + list(extra.items()), "doc_id long, text string")
    found = pii.report(pii.detect(table, pii.fit(table))).where("doc_id > 9000").collect()
    spans = {r.doc_id: r.spans for r in found}
    assert spans == {9001: "email:8:39", 9002: "card:5:24", 9003: "phone:6:20", 9004: "", 9005: "", 9006: ""}
