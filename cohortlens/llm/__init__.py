"""Operators for preparing text corpora for training: quality rules and
classifier, token counts, language-model scores, sharding, licence scan,
packing, near-duplicate join, fingerprints and a SentencePiece codec.
Nothing else in the library imports this subpackage."""
