from leafmill.plans.catalogue import ORACLES


def test_bundle_takes_as_many_as_the_reference():
    assert "position <= 200" in ORACLES["review_bundle"]
