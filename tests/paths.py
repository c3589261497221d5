"""Where the tests find their tables."""
SF001 = "/root/testdata/sf0.001"
