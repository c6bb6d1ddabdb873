"""SQL reports and the stage runner."""
