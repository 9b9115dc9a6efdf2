"""galeframe: storm, alert, satellite and telemetry analytics as Spark DataFrame operators."""
