"""DataFrame operators, grouped by the stage of the flow they belong to."""
