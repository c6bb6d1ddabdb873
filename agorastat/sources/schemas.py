"""Target types of the dump tables (S-19)."""

from __future__ import annotations

# Column names of the dump files in file order.
TABLES: dict[str, str] = {
    "posts": """
        Id BIGINT, PostTypeId INT, AcceptedAnswerId BIGINT, ParentId BIGINT,
        CreationDate TIMESTAMP, DeletionDate TIMESTAMP, Score INT, ViewCount INT, Body STRING,
        OwnerUserId BIGINT, OwnerDisplayName STRING, LastEditorUserId BIGINT,
        LastEditorDisplayName STRING, LastEditDate TIMESTAMP, LastActivityDate TIMESTAMP,
        Title STRING, Tags STRING, AnswerCount INT, CommentCount INT, FavoriteCount INT,
        ClosedDate TIMESTAMP, CommunityOwnedDate TIMESTAMP, ContentLicense STRING
    """,
    "users": """
        Id BIGINT, Reputation INT, CreationDate TIMESTAMP, DisplayName STRING,
        LastAccessDate TIMESTAMP, WebsiteUrl STRING, Location STRING, AboutMe STRING, Views INT,
        UpVotes INT, DownVotes INT, ProfileImageUrl STRING, AccountId BIGINT
    """,
    "comments": """
        Id BIGINT, PostId BIGINT, Score INT, Text STRING, CreationDate TIMESTAMP,
        UserDisplayName STRING, UserId BIGINT, ContentLicense STRING
    """,
    "tags": "Id BIGINT, TagName STRING, Count INT, ExcerptPostId BIGINT, WikiPostId BIGINT",
    "votes": """
        Id BIGINT, PostId BIGINT, VoteTypeId INT, UserId BIGINT, CreationDate TIMESTAMP,
        BountyAmount INT
    """,
    "badges": "Id BIGINT, UserId BIGINT, Name STRING, Date TIMESTAMP, Class INT, TagBased BOOLEAN",
    "post_links": """
        Id BIGINT, CreationDate TIMESTAMP, PostId BIGINT, RelatedPostId BIGINT, LinkTypeId INT
    """,
}

# File name of each dump table.
FILES: dict[str, str] = {
    "posts": "Posts.xml",
    "users": "Users.xml",
    "comments": "Comments.xml",
    "tags": "Tags.xml",
    "votes": "Votes.xml",
    "badges": "Badges.xml",
    "post_links": "PostLinks.xml",
}

API_PAGE = """
    items ARRAY<STRUCT<
        question_id: BIGINT, title: STRING, body: STRING, tags: ARRAY<STRING>, score: INT,
        view_count: INT, answer_count: INT, is_answered: BOOLEAN, creation_date: BIGINT,
        owner: STRUCT<reputation: INT, user_id: BIGINT>>>
"""


def columns(table: str) -> list[tuple[str, str]]:
    """``(name, type)`` pairs of a dump table."""
    if table not in TABLES:
        raise ValueError(f"Unknown table: {table}")
    pairs = (entry.split() for entry in TABLES[table].split(","))
    return [(name, kind) for name, kind in pairs]
