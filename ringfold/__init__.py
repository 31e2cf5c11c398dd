"""Entity resolution, behavioural features and risk scoring on Spark."""
