"""Values that the tests of the training-data operators share."""

SF = "/root/testdata/sf0.001"
# columns that documents may carry and that must not disturb any operator
EXTRA = "score double, start long, digest string, t string, rep long, n_words string, drop string, n_lines int, sig binary"
