"""Named plans: the reference's jobs over parsed records (``jobs``) and the
driver-table queries with their SQL oracles (``catalog``)."""
