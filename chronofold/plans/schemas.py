"""Declared schemas of the match tables and of the nested documents they come from."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the participants table.
PARTICIPANT_COLUMNS = """
matchId string, participantId smallint, puuid string, summonerId string, summonerLevel int,
summonerName string, ban int, championId int, championName string, championTransform smallint,
individualPosition string, lane string, pickTurn smallint, role string, rune_primary_0 smallint,
rune_primary_1 smallint, rune_primary_2 smallint, rune_primary_3 smallint, rune_secondary_0
smallint, rune_secondary_1 smallint, rune_shard_defense smallint, rune_shard_flex smallint,
rune_shard_offense smallint, summoner1Id smallint, summoner2Id smallint, teamId smallint,
teamPosition string, allInPings int, assistMePings int, basicPings int, commandPings int,
dangerPings int, enemyMissingPings int, enemyVisionPings int, getBackPings int, holdPings int,
needVisionPings int, onMyWayPings int, pushPings int, retreatPings int, visionClearedPings int,
damageDealtToBuildings int, damageDealtToObjectives int, damageDealtToTurrets int,
damageSelfMitigated int, largestCriticalStrike smallint, magicDamageDealt int,
magicDamageDealtToChampions int, magicDamageTaken int, physicalDamageDealt int,
physicalDamageDealtToChampions int, physicalDamageTaken int, totalDamageDealt int,
totalDamageDealtToChampions int, totalDamageShieldedOnTeammates int, totalDamageTaken int, totalHeal
int, totalHealsOnTeammates int, trueDamageDealt int, trueDamageDealtToChampions int, trueDamageTaken
int, timeCCingOthers int, timePlayed int, totalTimeCCDealt int, totalTimeSpentDead int,
firstBloodAssist boolean, firstBloodKill boolean, firstTowerAssist boolean, firstTowerKill boolean,
baronKills smallint, bountyLevel smallint, consumablesPurchased smallint, detectorWardsPlaced
smallint, doubleKills smallint, dragonKills smallint, inhibitorKills smallint, inhibitorTakedowns
smallint, inhibitorsLost smallint, itemsPurchased smallint, killingSprees smallint,
largestKillingSpree smallint, largestMultiKill smallint, longestTimeSpentLiving smallint,
neutralMinionsKilled smallint, nexusKills smallint, nexusLost smallint, nexusTakedowns smallint,
objectivesStolen smallint, objectivesStolenAssists smallint, pentaKills smallint, quadraKills
smallint, sightWardsBoughtInGame smallint, spell1Casts smallint, spell2Casts smallint, spell3Casts
smallint, spell4Casts smallint, summoner1Casts smallint, summoner2Casts smallint,
totalAllyJungleMinionsKilled smallint, totalEnemyJungleMinionsKilled smallint, totalMinionsKilled
smallint, totalUnitsHealed smallint, tripleKills smallint, turretKills smallint, turretTakedowns
smallint, turretsLost smallint, unrealKills smallint, visionWardsBoughtInGame smallint, wardsKilled
smallint, wardsPlaced smallint, item0 smallint, item1 smallint, item2 smallint, item3 smallint,
item4 smallint, item5 smallint, item6 smallint, kills smallint, champExperience int, champLevel
smallint, assists smallint, deaths smallint, goldEarned int, goldSpent int, visionScore smallint,
eligibleForProgression boolean, gameEndedInEarlySurrender boolean, gameEndedInSurrender boolean,
placement smallint, playerSubteamId smallint, profileIcon int, subteamPlacement smallint,
teamEarlySurrendered boolean, win boolean
"""

# Fields of a champion-statistics struct.
CHAMPION_STATS = """
abilityHaste smallint, abilityPower smallint, armor smallint, armorPen smallint, armorPenPercent
smallint, attackDamage smallint, attackSpeed smallint, bonusArmorPenPercent smallint,
bonusMagicPenPercent smallint, ccReduction smallint, cooldownReduction smallint, health int,
healthMax int, healthRegen int, lifesteal smallint, magicPen smallint, magicPenPercent smallint,
magicResist smallint, movementSpeed int, omnivamp smallint, physicalVamp smallint, power smallint,
powerMax smallint, powerRegen smallint, spellVamp smallint
"""

# Fields of a damage-totals struct.
DAMAGE_STATS = """
magicDamageDone int, magicDamageDoneToChampions int, magicDamageTaken int, physicalDamageDone int,
physicalDamageDoneToChampions int, physicalDamageTaken int, totalDamageDone int,
totalDamageDoneToChampions int, totalDamageTaken int, trueDamageDone int, trueDamageDoneToChampions
int, trueDamageTaken int
"""

# Fields of one entry of a damage list.
DAMAGE_ENTRY = """
basic boolean, magicDamage int, name string, participantId smallint, physicalDamage int, spellName
string, spellSlot int, trueDamage int, type string
"""

# Columns of the events table.
EVENT_COLUMNS = """
matchId string, eventId smallint, positionX int, positionY int, teamId smallint, timestamp int, type
string, winningTeam smallint, featType smallint, featValue smallint, currentGold int, goldGain
smallint, goldPerSecond smallint, shutdownBounty smallint, totalGold int, afterId int, beforeId int,
inventoryIds array<int>, inventoryCounts array<tinyint>, itemId int, jungleMinionsKilled smallint,
monsterSubType string, monsterType string, name string, bounty smallint, killerId smallint,
killerTeamId smallint, killStreakLength smallint, killType string, multiKillLength smallint,
numberOfAssists tinyint, victimDamageDealt damage_list, victimDamageReceived
damage_list, victimId smallint, buildingType string, laneType string, towerType string,
level smallint, levelUpType string, skillSlot smallint, xp int, championStats champion_stats,
damageStats damage_stats, minionsKilled smallint, participantId smallint, timeEnemySpentControlled
int, wardType string
"""

# Columns of the matches table that do not belong to a team.
MATCH_COLUMNS = """
endOfGameResult string, gameDuration int, gameEndTimestamp bigint, gameId bigint, gameStartTimestamp
bigint, matchId string, patch string, platformId string, region string, tournamentCode string,
winner_team_id smallint
"""

# Team ids, feats and objectives; they name the team columns of the matches table.
TEAM_IDS = (100, 200)
FEATS = ("EPIC_MONSTER_KILL", "FIRST_BLOOD", "FIRST_TURRET")
OBJECTIVES = ("atakhan", "baron", "champion", "dragon", "horde", "inhibitor", "riftHerald", "tower")

# Participant columns that are computed rather than read.
DERIVED_PARTICIPANT_COLUMNS = (
    "matchId", "ban", "pickTurn",
    "rune_primary_0", "rune_primary_1", "rune_primary_2", "rune_primary_3",
    "rune_secondary_0", "rune_secondary_1",
    "rune_shard_defense", "rune_shard_flex", "rune_shard_offense",
)

PLAYERS = tuple(range(1, 11))


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(), "boolean": T.BooleanType(), "tinyint": T.ByteType(), "smallint": T.ShortType(),
    "int": T.IntegerType(), "bigint": T.LongType(),
    "array<int>": T.ArrayType(T.IntegerType()),
    "array<tinyint>": T.ArrayType(T.ByteType()),
    "array<smallint>": T.ArrayType(T.ShortType()),
}


def _struct(columns: str) -> T.StructType:
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_TYPES["point"] = _struct("x int, y int")
_TYPES["champion_stats"] = _struct(CHAMPION_STATS)
_TYPES["damage_stats"] = _struct(DAMAGE_STATS)
_TYPES["damage_list"] = T.ArrayType(_struct(DAMAGE_ENTRY))

PARTICIPANTS = _struct(PARTICIPANT_COLUMNS)
EVENTS = _struct(EVENT_COLUMNS)

#: One frame of one player.
FRAME = _struct(
    "currentGold int, goldPerSecond smallint, jungleMinionsKilled smallint, level smallint, "
    "minionsKilled smallint, timeEnemySpentControlled int, totalGold int, xp int, "
    "position point, championStats champion_stats, damageStats damage_stats"
)

#: One event as it stands in a timeline document.
_FROM_FRAME_ONLY = {f.name for f in FRAME} - {"level"}
_COMPUTED = {"matchId", "eventId", "positionX", "positionY", "inventoryIds", "inventoryCounts", "numberOfAssists"}
RAW_EVENT = T.StructType(
    [f for f in EVENTS if f.name not in _FROM_FRAME_ONLY | _COMPUTED]
    + _struct(
        "creatorId smallint, actualStartTime int, assistingParticipantIds array<smallint>, position point"
    ).fields
)

TIMELINE = T.StructType([
    T.StructField("metadata", T.StructType([T.StructField("matchId", T.StringType())])),
    T.StructField("info", T.StructType([
        T.StructField("frames", T.ArrayType(T.StructType([
            T.StructField("timestamp", T.IntegerType()),
            T.StructField("participantFrames", T.MapType(T.StringType(), FRAME)),
            T.StructField("events", T.ArrayType(RAW_EVENT)),
        ]))),
    ])),
])

_RUNE = _struct("perk smallint")
_PERKS = T.StructType([
    T.StructField("statPerks", T.MapType(T.StringType(), T.ShortType())),
    T.StructField("styles", T.ArrayType(T.StructType([T.StructField("selections", T.ArrayType(_RUNE))]))),
])
_TEAM = T.StructType([
    *_struct("teamId smallint, win boolean").fields,
    T.StructField("bans", T.ArrayType(_struct("championId int, pickTurn smallint"))),
    T.StructField("feats", T.MapType(T.StringType(), _struct("featState smallint"))),
    T.StructField("objectives", T.MapType(T.StringType(), _struct("first boolean, kills smallint"))),
])
RAW_PARTICIPANT = T.StructType(
    [f for f in PARTICIPANTS if f.name not in DERIVED_PARTICIPANT_COLUMNS] + [T.StructField("perks", _PERKS)]
)
MATCH_INFO = T.StructType([
    T.StructField("metadata", T.StructType([T.StructField("matchId", T.StringType())])),
    T.StructField("info", T.StructType(
        [f for f in _struct(MATCH_COLUMNS) if f.name not in ("matchId", "patch", "region", "winner_team_id")]
        + _struct("gameVersion string, queueId int").fields
        + [
            T.StructField("teams", T.ArrayType(_TEAM)),
            T.StructField("participants", T.ArrayType(RAW_PARTICIPANT)),
        ]
    )),
])


def _team_fields() -> list[T.StructField]:
    fields = []
    for team in TEAM_IDS:
        fields += [T.StructField(f"team_{team}_{feat}", T.ShortType()) for feat in FEATS]
    for team in TEAM_IDS:
        for objective in OBJECTIVES:
            fields.append(T.StructField(f"team_{team}_{objective}_first", T.BooleanType()))
            fields.append(T.StructField(f"team_{team}_{objective}_kills", T.ShortType()))
    return fields


def _matches() -> T.StructType:
    plain = _struct(MATCH_COLUMNS).fields
    return T.StructType([*plain[:9], *_team_fields(), *plain[9:]])


MATCHES = _matches()
