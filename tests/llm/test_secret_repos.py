from helpers import DOCS

from rillflow.llm.secrets import scan


def test_a_value_in_many_repositories_of_one_owner_is_an_example(spark):
    copied, live = "zz11yy22xx33ww44vv55", "aB3dE5gH7jK9mN1pQ3sT"
    rows = [(i, copied, lang, "s", 20) for i, lang in enumerate(("en", "de", "fr"))] + [(9, live, "en", "s", 20), (10, live, "de", "s", 20)]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i].found == [] and got[i].n_example == 1 and (got[i].most_owners, got[i].most_repos) == (1, 3) for i in range(3))
    assert all(len(got[i].found) == 1 and got[i].n_live == 1 and (got[i].most_owners, got[i].most_repos) == (1, 2) for i in (9, 10))


def test_a_repository_of_several_owners_counts_once(spark):
    value = "aB3dE5gH7jK9mN1pQ3sT"
    rows = [(i, value, "en", owner, 20) for i, owner in enumerate(("s", "t"))] * 40  # a value that most rows hold is answered in place
    got = scan(spark.createDataFrame(rows, DOCS), repo_cols=("lang",)).collect()
    assert len(got) == 80 and all((r.most_owners, r.most_repos, r.n_live) == (2, 1, 1) for r in got)
