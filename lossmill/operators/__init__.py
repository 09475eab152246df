"""DataFrame-to-DataFrame operators: typing, joins, quality, marts, profiles, naming."""
