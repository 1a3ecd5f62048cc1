"""One document of each group stays, whatever the ids are."""

from letterscope.llm import near_dedup


def test_null_and_repeated_ids_keep_one_of_each_group(spark):
    words = [f"alpha{i} beta gamma{i % 9}" for i in range(40)]
    near, other = [" ".join(words), " ".join(words[:-1]), " ".join(words).upper()], "quite different words stand here"
    rows = [(None, t) for t in [*near, other, "", " "]]
    assert sorted(r.text for r in near_dedup.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()) in [
        sorted([t, other, "", " "]) for t in near]
    rows = [(7, near[0]), (7, near[1]), (8, near[2]), (None, near[0]), (9, other), (9, other), (9, "")]
    kept = near_dedup.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == [7, 9, 9] and sum(r.text in near for r in kept) == 1
