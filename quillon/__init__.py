"""quillon: selection-experiment analytics and corpus preparation as Spark plans."""
