"""Operators for preparing training data: deduplication, joins on word
shingles, filters, labelling, packing and sharding of whole corpora.
Nothing else in the library imports this subpackage."""
