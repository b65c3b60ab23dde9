"""check_extra_slots over the whole chain."""

from __future__ import annotations

from forkline.operators import reads
from forkline.plans import catalog

SF = "/root/testdata/sf0.001"


def test_the_whole_chain_is_expected_and_a_late_extra_slot_is_found(spark):
    assert catalog.check_extra_slots(spark, SF).count() == 0
    expected = catalog._whole_chain(spark, SF)
    slots = catalog.run(spark, SF).slots
    canonical = reads.canonical_slots(slots).select("slot")
    assert sorted(r[0] for r in expected.collect()) == sorted(r[0] for r in canonical.collect())
    assert [r[0] for r in catalog.extra_slots(slots, expected.where("slot <> 201")).collect()] == [201]
