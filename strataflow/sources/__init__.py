"""Landing files, seeds and the tables of the warehouse."""
