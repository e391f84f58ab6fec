"""Values the tests share."""

SF = "/root/testdata/sf0.001"
