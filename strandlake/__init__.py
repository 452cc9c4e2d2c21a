"""strandlake: guide-site design and similarity search over DNA, as Spark jobs."""
