"""Where the given tables are.  Not in ``conftest``: a second conftest below would shadow that name."""

SF_SMALL = "/root/testdata/sf0.001"
