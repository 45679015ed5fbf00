"""carelake: integrate heterogeneous health records with Spark and query them as tables and as a graph."""
