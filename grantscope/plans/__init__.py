"""Named query plans (what ``__spark_entry__`` registers) and their SQL oracles."""
