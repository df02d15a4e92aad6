"""proofline: profile, clean, gate, featurise and audit tables with Spark."""
