"""Operators for training-data pipelines: filters, classifiers, joins, tokenizers and packing over documents."""
