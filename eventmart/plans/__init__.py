"""Bronze, silver and gold data sets, their storage, and the refresh that ties them."""
