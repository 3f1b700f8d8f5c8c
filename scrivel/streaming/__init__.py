"""The stateless record job over folders that keep filling up."""
