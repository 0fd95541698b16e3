"""groundtable: listing normalisation, grounding and reporting as Spark plans."""
