"""Group labels that reports are read by."""

# Fixed values. The suspect's own label is its tool and chamber, with these around or beside it.
OTHERS = "Others"
ALL_OTHERS = "All others"
BAD_SUFFIX = " (bad)"
SUSPECT_PREFIX = "Suspect: "
PEERS = ("Other ", " chambers")
