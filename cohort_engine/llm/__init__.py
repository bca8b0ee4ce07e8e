"""Training-data operators: extraction, scoring, counting, packing, decontamination, derivatives, deduplication,
sharding and vector search.  Nothing else in the library imports this subpackage."""
