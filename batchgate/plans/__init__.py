"""The wired job: the rule set of the fish preset, and the admission of a batch."""
