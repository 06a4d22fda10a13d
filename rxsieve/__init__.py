"""Campaign drug-list validation and loading as Spark jobs."""

from rxsieve.params import CampaignParams

__all__ = ["CampaignParams"]
